"""Personal data by weak supervision: labelers vote on candidate spans, their reliabilities are estimated, and a
span classifier trained on the estimated labels decides.

1. Every text is searched for spans of a strict form (the base: email, ip, card, phone) and for looser candidates
   (spelled-out addresses, IPv6, numbers in groups). Strict spans are kept whatever the method says.
   "at" with plain dots around it is ordinary prose ("look at example.com") and a candidate only after a cue such as "mail".
2. Five labelers look at each candidate and vote for, against or not at all: two on its form (shape, checksum), a
   gazetteer of domain endings, card ranges and address blocks, one on the words before it and one on its edges.
3. Candidates with the same kind, votes and coarse shape are one pattern. There are at most a few thousand patterns
   however large the corpus is, and their counts over *all* texts are what the models are trained on.
4. Expectation-maximisation over the pattern counts estimates each labeler's reliability and so, for each pattern, the
   probability of personal data. Strict and loose candidates of a kind are estimated apart: strict ones are nearly all
   personal and would teach that every vote is. It starts from fixed beliefs about the labelers that weigh as much as
   ``_BELIEF`` candidates, so a corpus that has no counter-examples cannot turn a labeler around. A logistic classifier
   over votes and shape is trained on the soft labels of the loose candidates.
5. Candidates that the classifier gives at least ``threshold`` are added where they do not overlap a span that stands.

Texts are read once: candidates and patterns are written to a table in the shared folder, which both the counting and
the final decision read. A NULL or empty text has no spans. Rows are judged one by one, so repeated rows and repeated
ids give repeated results, and ties cannot occur. An empty table gives an empty result. Other columns, whatever their
names, are not read. Work on a text is linear in its length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import in_small_batches, staged, table

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_ANY_DIGIT = re.compile(r"[0-9]")
# Looking back is no restriction: a run of digits is consumed whole by a match. It keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser candidates.
_SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]{1,64})(?: at | ?\[at\] ?| ?\(at\) ?)"
    r"([A-Za-z0-9-]{1,63}(?:(?: dot | ?\[dot\] ?| ?\(dot\) ?|\.)[A-Za-z0-9-]{2,63}){1,4})(?![A-Za-z0-9-])"
)
_IPV6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_GROUPED = re.compile(r"(?<![0-9A-Za-z.+-])\(?[0-9]{2,4}\)?(?:[ .-]?\(?[0-9]{2,5}\)?){1,5}(?![0-9A-Za-z])")

# Words and endings that the gazetteer and context labelers know.
ENDINGS = frozenset("com org net edu gov io info biz co uk de fr es it nl eu us ca au jp ch at be".split())
CUES = {
    "email": frozenset("mail email e-mail contact address write correo courriel".split()),
    "ip": frozenset("ip host server address addr login from client".split()),
    "card": frozenset("card visa mastercard amex credit debit payment tarjeta carte karte".split()),
    "phone": frozenset("phone tel telephone call mobile fax cell contact telefon tél teléfono".split()),
}
AGAINST = frozenset("version v no number order page isbn issn id total price sum figure chapter section lines".split())

_PATTERN_VOTES = 5
#: What is believed before a corpus is seen: chances of the votes + - 0 of each labeler for personal data and for other spans,
#: the share of personal data among loose candidates, and how many candidates these beliefs weigh.
_BELIEFS = (
    ((0.75, 0.10, 0.15), (0.20, 0.60, 0.20)),  # shape
    ((0.60, 0.10, 0.30), (0.15, 0.55, 0.30)),  # checksum
    ((0.60, 0.15, 0.25), (0.40, 0.35, 0.25)),  # gazetteer
    ((0.55, 0.05, 0.40), (0.05, 0.35, 0.60)),  # words before
    ((0.85, 0.15, 0.00), (0.65, 0.35, 0.00)),  # edges
)
_SHARE, _BELIEF = 0.2, 200
#: Candidates that each pattern counts more in training, so that the votes of rare ones are learned too.
_RARE = 20
_WORDS_BEFORE = re.compile(r"[\w-]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, ``@`` and domain; found from the ``@``, as a local part ends nowhere else."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            after = found.end()
        at = text.find("@", max(after, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the strict forms, by kind and start, in code points; kinds are indexes into KINDS."""
    spans = [(0, *s) for s in _emails(text)] if "@" in text else []
    if _ANY_DIGIT.search(text) is None:
        return spans
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                spans.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 37 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            spans.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                spans.append((3, *m.span()))
    return spans


def _plain_at(text: str, start: int, span: str) -> bool:
    """Whether a spelled-out address has neither brackets nor "dot" nor a cue in the words before it."""
    if "[" in span or "(" in span or " dot " in span:
        return False
    return not any(w.lower() in CUES["email"] for w in _WORDS_BEFORE.findall(text, max(0, start - 40), start)[-4:])


def loose_spans(text: str) -> list[tuple[int, int, int]]:
    """Further candidates, of the same kinds. A grouped number of 13 digits or more is a card if its check digit is right,
    else nothing; a shorter one may be a phone."""
    spans = []
    if " at " in text or "at]" in text or "at)" in text:
        spans = [(0, *m.span()) for m in _SPELLED.finditer(text) if not _plain_at(text, m.start(), m[0])]
    if _ANY_DIGIT.search(text) is None:
        return spans
    if ":" in text:
        spans += [(1, *m.span()) for m in _IPV6.finditer(text)]
    for m in _GROUPED.finditer(text):
        n = len(digits := _digits(m[0]))
        if 7 <= n <= 12:
            spans.append((3, *m.span()))
        elif 13 <= n <= 19 and luhn(digits):
            spans.append((2, *m.span()))
    return spans


def _outside(spans: list[tuple[int, int, int]], standing: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans that overlap none of ``standing`` and none of the earlier spans that passed; in order of start."""
    taken = sorted((s, e) for _, s, e in standing)
    free, at, last = [], 0, 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2], x[0])):
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if start >= last and (at == len(taken) or taken[at][0] >= end):
            free.append((kind, start, end))
            last = end
    return free


def votes(text: str, kind: int, start: int, end: int, strict: bool) -> str:
    """The pattern of a candidate: kind, five votes (``+``, ``-``, ``0``), and coarse shape."""
    span = text[start:end]
    digits = _digits(span)
    n = len(digits)
    shape = checksum = gazetteer = "0"
    if strict:
        shape = "+"
    if kind == 0:
        ending = re.split(r"[^A-Za-z0-9-]+", span)[-1].lower()
        gazetteer = "+" if ending in ENDINGS else "-"
        if not strict:
            shape = "+" if "[" in span or "(" in span or " dot " in span else "0"
    elif kind == 1:
        parts = span.split("." if "." in span else ":")
        gazetteer = "-" if parts[0] in ("0", "255") else "+"
        if not strict:
            shape = "+" if len(parts) == 8 else "0"
    elif kind == 2:
        checksum = "+" if luhn(digits) else "-"
        gazetteer = "+" if digits[0] in "3456" else "-"
        if not strict:
            shape = "+" if n == 15 or n == 16 else "-"
    else:
        if not strict:
            shape = "+" if n in (10, 11) and re.search(r"[ ().-]", span) else "-"
        gazetteer = "-" if len(set(digits)) <= 2 or digits.startswith("0000") else "0"
    before = [w.lower() for w in _WORDS_BEFORE.findall(text, max(0, start - 40), start)][-4:]
    context = "+" if any(w in CUES[KINDS[kind]] for w in before) else "-" if any(w in AGAINST for w in before) else "0"
    left, right = text[start - 1 : start], text[end : end + 1]
    edges = "-" if left.isalnum() or right.isalnum() or left in "=/$#" and left else "+"
    coarse = min(3, (end - start) // 10)
    return f"{kind}{shape}{checksum}{gazetteer}{context}{edges}{int(strict)}{coarse}"


_CANDIDATES = "array<struct<kind:int,start:int,stop:int,strict:boolean,pattern:string>>"
_CANDIDATE_ARROW = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("strict", pa.bool_()), ("pattern", pa.string())])


def _search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for text in batch["text"]:
            spans = []
            if text:
                base = base_spans(text)
                spans = [(k, s, e, True, votes(text, k, s, e, True)) for k, s, e in base]
                spans += [(k, s, e, False, votes(text, k, s, e, False)) for k, s, e in _outside(loose_spans(text), base)]
            found.append([dict(zip(("kind", "start", "stop", "strict", "pattern"), x, strict=True)) for x in spans])
        yield pd.DataFrame({"id": batch["id"], "spans": found})


def find_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id and all candidate spans with their patterns, written to the shared folder."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return staged(rows.mapInPandas(_search, f"id {kind}, spans {_CANDIDATES}"), "pii")


def pattern_counts(candidates: DataFrame) -> dict[str, int]:
    """Counts over all candidates. The alphabet of patterns bounds their number, so they may go to the driver."""
    counted = candidates.select(F.explode("spans.pattern").alias("pattern")).groupBy("pattern").count()
    return {r["pattern"]: r["count"] for r in counted.collect()}


def _group(pattern: str) -> tuple[int, bool]:
    return int(pattern[0]), pattern[-2] == "1"


def estimate_reliabilities(counts: dict[str, int], rounds: int = 50) -> tuple[dict[str, float], dict[tuple[int, int], np.ndarray]]:
    """Expectation-maximisation with two hidden classes for each kind, strict and loose candidates apart.

    Returns the probability of personal data for each pattern, and for each (kind, labeler), over both, the probabilities of the
    votes ``+``, ``-``, ``0`` given personal data and given none. The beliefs count as ``_BELIEF`` further candidates, with
    ``_SHARE`` of them personal among loose ones and nearly all among strict ones.
    """
    posterior: dict[str, float] = {}
    beliefs = np.array(_BELIEFS)
    for kind, strict in sorted({_group(p) for p in counts}):
        own = sorted(p for p in counts if _group(p) == (kind, strict))
        share = 0.95 if strict else _SHARE
        weight = np.array([counts[p] for p in own], float)
        vote = np.array([["+-0".index(c) for c in p[1 : 1 + _PATTERN_VOTES]] for p in own])
        prior, given = share, beliefs
        for _ in range(rounds):
            log_odds = np.full(len(own), np.log(prior / (1 - prior)))
            for j in range(_PATTERN_VOTES):
                log_odds += np.log(np.maximum(given[j, 0], 1e-3) / np.maximum(given[j, 1], 1e-3))[vote[:, j]]
            q = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
            prior = (weight @ q + share * _BELIEF) / (weight.sum() + _BELIEF)
            seen = np.array([[[weight[vote[:, j] == v] @ c[vote[:, j] == v] for v in range(3)] for c in (q, 1 - q)] for j in range(_PATTERN_VOTES)])
            seen += beliefs * _BELIEF * np.array([share, 1 - share])[None, :, None]
            given = seen / seen.sum(2, keepdims=True)
        posterior |= dict(zip(own, q, strict=True))
    reliability = {}
    for kind, j in {(int(p[0]), j) for p in counts for j in range(_PATTERN_VOTES)}:
        found = np.ones((2, 3))
        for p in counts:
            if int(p[0]) == kind:
                found[:, "+-0".index(p[1 + j])] += counts[p] * np.array([posterior[p], 1 - posterior[p]])
        reliability[kind, j] = found / found.sum(1, keepdims=True)
    return posterior, reliability


def _features(pattern: str) -> np.ndarray:
    kind, coarse = int(pattern[0]), int(pattern[-1])
    x = np.zeros(1 + len(KINDS) * 11 + 4)
    x[0] = 1
    x[1 + kind * 11] = 1
    for j, v in enumerate(pattern[1 : 1 + _PATTERN_VOTES]):
        if v != "0":
            x[1 + kind * 11 + 1 + 2 * j + (v == "-")] = 1
    x[1 + len(KINDS) * 11 + coarse] = 1
    return x


def train_span_classifier(counts: dict[str, int], posterior: dict[str, float], rounds: int = 30, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic model fitted by Newton steps to the soft labels of the loose candidates, patterns being weighted by count."""
    names = sorted(p for p in counts if not _group(p)[1])
    if not names:
        return np.zeros(1 + len(KINDS) * 11 + 4)
    x = np.array([_features(p) for p in names])
    y = np.array([posterior[p] for p in names])
    n = np.array([counts[p] + _RARE for p in names], float)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - y)) + ridge * w
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        w -= step / max(1.0, np.abs(step).max() / 4)
    return w


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per row: id, ``base`` and ``added`` spans, both as arrays of (kind, start, stop) with kind as its name."""
    in_small_batches(docs.sparkSession)
    candidates = find_candidates(docs, id_col, text_col)
    counts = pattern_counts(candidates)
    posterior, _ = estimate_reliabilities(counts)
    weights = train_span_classifier(counts, posterior)
    good = [p for p in counts if _features(p) @ weights >= np.log(threshold / (1 - threshold))]
    name = F.array(*[F.lit(k) for k in KINDS])

    def chosen(keep):
        return F.transform(
            F.filter("spans", keep),
            lambda s: F.struct(name[s["kind"]].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("rank")),
        )

    accepted = F.array(*[F.lit(p) for p in sorted(good)]).cast("array<string>")
    return candidates.select(
        F.col("id").alias(id_col),
        chosen(lambda s: s["strict"]).alias("base"),
        chosen(lambda s: ~s["strict"] & F.array_contains(accepted, s["pattern"])).alias("added"),
    )


def spans_text(spans) -> Column:
    """``kind:start:end``, comma-joined, by kind as listed and start."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["rank"].alias("rank"), s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[F.size(_of_kind("base", k)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
        F.size(F.concat("base", "added")).cast("long").alias("n_spans"),
    )


def _redacted(text: str | None, spans) -> str | None:
    if text is None or len(spans) == 0:
        return text
    parts, at = [], 0
    # Base spans of different kinds may overlap: they are blotted out together, under the name of the first.
    for start, end, kind in sorted((s["start"], s["stop"], s["kind"]) for s in spans):
        if end <= at:
            continue
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join(parts) + text[at:]


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", threshold: float = 0.5) -> DataFrame:
    """The rows with each span replaced by its kind in brackets, and ``length_col``, if there is one, set anew.

    The rows are written once with their candidates, so nothing has to be joined back. Both passes map whole batches of
    rows, so a worker holds no more than a batch of them; the other columns pass through as they are.
    """
    in_small_batches(docs.sparkSession)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    spans_type = f"row {row.schema['row'].dataType.simpleString()}, spans {_CANDIDATES}"
    row = staged(row.mapInArrow(_with_spans(text_col), spans_type), "pii-rows")
    counts = pattern_counts(row.select("spans"))
    posterior, _ = estimate_reliabilities(counts)
    weights = train_span_classifier(counts, posterior)
    good = sorted(p for p in counts if _features(p) @ weights >= np.log(threshold / (1 - threshold)))
    accepted = F.array(*[F.lit(p) for p in good]).cast("array<string>")
    chosen = F.filter("spans", lambda s: s["strict"] | F.array_contains(accepted, s["pattern"]))
    chosen = F.transform(chosen, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    cleaned = row.select("row", chosen.alias("spans")).mapInArrow(
        _cleaned(text_col), f"row {row.schema['row'].dataType.simpleString()}, clean string"
    )
    out = []
    for field in docs.schema.fields:
        if field.name == text_col:
            value = F.col("clean")
        elif field.name == length_col:
            value = F.when(F.col("clean").isNotNull(), F.length("clean")).cast(field.dataType)
        else:
            value = F.col("row").getField(field.name)
        out.append(value.alias(field.name))
    return cleaned.select(*out)


def _with_spans(text_col: str):
    def search(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("row").field(text_col).to_pylist()
            found = next(_search(iter([pd.DataFrame({"id": 0, "text": pd.Series(texts, dtype=object)})])))["spans"]
            spans = pa.array(list(found), type=pa.list_(_CANDIDATE_ARROW))
            yield pa.RecordBatch.from_arrays([batch.column("row"), spans], ["row", "spans"])

    return search


def _cleaned(text_col: str):
    def clean(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("row").field(text_col).to_pylist()
            spans = batch.column("spans").to_pylist()
            out = pa.array([t if not s else _redacted(t, s) for t, s in zip(texts, spans, strict=True)], batch.column("row").field(text_col).type)
            yield pa.RecordBatch.from_arrays([batch.column("row"), out], ["row", "clean"])

    return clean
