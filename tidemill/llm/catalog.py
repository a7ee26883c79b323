"""The registered queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm.bloom_lm import op10_bloom_lm
from tidemill.llm.collocations import OP12_SQL, op12_collocations
from tidemill.llm.decontaminate import op2_decontamination
from tidemill.llm.exact_copies import OP13_SQL, op13_exact_dedup
from tidemill.llm.hosts import OP6_SQL, op6_host_reputation
from tidemill.llm.jaccard import op4_ngram_jaccard
from tidemill.llm.langid import op8_language_id
from tidemill.llm.lexical import OP11_SQL, op11_ranked_search
from tidemill.llm.outliers import op7_outliers
from tidemill.llm.pieces import op9_sentencepiece
from tidemill.llm.pii import op1_pii
from tidemill.llm.secrets import op3_secrets
from tidemill.llm.toxicity import op5_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_decontamination": op2_decontamination,
    "op3_secrets": op3_secrets,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_toxicity": op5_toxicity,
    "op6_host_reputation": op6_host_reputation,
    "op7_outliers": op7_outliers,
    "op8_language_id": op8_language_id,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_bloom_lm": op10_bloom_lm,
    "op11_ranked_search": op11_ranked_search,
    "op12_collocations": op12_collocations,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLE: dict[str, str] = {"op6_host_reputation": OP6_SQL, "op11_ranked_search": OP11_SQL, "op12_collocations": OP12_SQL, "op13_exact_dedup": OP13_SQL}
