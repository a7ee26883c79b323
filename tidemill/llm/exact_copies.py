"""Exact copies, combined in three steps: within a task, within a salt, and over all salts.

Two texts are equal if they are the same after every ASCII space and control of ``[\\x20\\x09-\\x0D]`` has been deleted. Of equal
texts the row with the most code points in its original text stays; of these the least id, and of these the first row.

1. Each task combines the rows of a stretch of its input. One row of each different text leads there and keeps the text.
2. Leaders are shuffled by digest. Digests with many leaders are dealt over salts, by a count of digests alone: those
   with more than 1/65,536 of all leaders, of which there are fewer than 65,536 at any scale, go through a broadcast.
3. The winners of the salts of a digest are combined. Only these texts are shuffled a second time.

In each step rows are one group only if their full texts are the same; the digest just says where they meet. Afterwards
rows find their group by the digest if the comparison found one text under it. Should several texts share a digest,
their rows are told apart by the text again.

A NULL text counts as an empty one, and blank texts are copies of it. NULL ids come last in the order of ids. Repeated rows,
also with the same id, are copies of each other, of which one stays. Texts may be of any length; an empty table gives
an empty result. Columns other than id and text are only carried, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import staged, table
from tidemill.operators.joins import attach_by_key

_WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
_LEADERS = 64  # of a digest that one task takes in any case
_MAX_HOT = 65_536


def sha256(body: bytes) -> bytes:
    return hashlib.sha256(body).digest()


def _combine(rows: pa.Table, digest: Callable[[bytes], bytes]) -> pa.RecordBatch:
    """The rows of a stretch: each with its digest and leader, and the leaders with the text and the number of copies."""
    groups: dict[bytes, int] = {}
    which = [groups.setdefault((b or b"").translate(None, _WHITE), len(groups)) for b in rows["text"].to_pylist()]
    bodies = list(groups)
    chars, ids, at = (rows[c].to_pylist() for c in ("chars", "id", "at"))
    leader, copies = [-1] * len(bodies), [0] * len(bodies)
    for i in sorted(range(len(which)), key=lambda i: (-chars[i], ids[i] is None, ids[i], at[i])):
        if leader[which[i]] < 0:
            leader[which[i]] = i
        copies[which[i]] += 1
    leads = [leader[g] == i for i, g in enumerate(which)]
    digests = [digest(body) for body in bodies]
    made = {
        "digest": pa.array([digests[g] for g in which], pa.binary()),
        "leader": pa.array([at[leader[g]] for g in which], pa.int64()),
        "body": pa.array([bodies[g] if lead else None for g, lead in zip(which, leads, strict=True)], pa.binary()),
        "copies": pa.array([copies[g] if lead else 0 for g, lead in zip(which, leads, strict=True)], pa.int64()),
    }
    for name, column in made.items():
        rows = rows.append_column(name, column)
    return rows.drop_columns(["text"]).combine_chunks().to_batches()[0]


def _combining(digest: Callable[[bytes], bytes], stretch_bytes: int):
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if held and size >= stretch_bytes:
                yield _combine(pa.Table.from_batches(held), digest)
                held, size = [], 0
        if held:
            yield _combine(pa.Table.from_batches(held), digest)

    return combine


def _order() -> Column:
    """What stays comes first."""
    return F.struct((-F.col("chars")).alias("fewer"), F.col("id").isNull().alias("without"), "id", "at")


def _classes(local: DataFrame) -> DataFrame:
    """One row for each different text: digest, ``first`` (in the order of ``_order``) and the number of rows."""
    leaders = local.where("copies > 0")
    total = leaders.count()
    unit = max(_LEADERS, total // _MAX_HOT)
    hot = leaders.groupBy("digest").count().where(F.col("count") > unit)
    hot = hot.select("digest", F.ceil(F.col("count") / unit).alias("salts"))
    dealt = leaders.join(F.broadcast(hot), "digest", "left").select(
        "digest", "body", "copies", _order().alias("first"), F.pmod(F.xxhash64("at"), F.col("salts")).alias("salt")
    )
    salted = (
        dealt.repartition("digest", "salt")
        .groupBy("digest", "salt", "body")
        .agg(F.min("first").alias("first"), F.sum("copies").alias("copies"))
    )
    # Without salts a group is whole by now, and its text need not go along any more.
    whole = F.col("salt").isNull()
    return (
        salted.groupBy("digest", F.when(~whole, F.col("body")).alias("body"), F.when(whole, F.col("first.at")).alias("own"))
        .agg(F.min("first").alias("first"), F.sum("copies").alias("copies"))
        .select("digest", "first", "copies")
    )


def _by_text(local: DataFrame, classes: DataFrame, shared: DataFrame) -> DataFrame:
    """The rows under digests that several texts share, each with its class."""
    leaders = local.where("copies > 0").join(shared, "digest", "left_semi").select("digest", "body", "at")
    firsts = classes.join(shared, "digest", "left_semi").select(F.col("first.at").alias("at"), "first", "copies")
    texts = leaders.join(firsts, "at").select("digest", "body", "first", "copies")
    by_leader = leaders.join(texts, ["digest", "body"]).select(F.col("at").alias("leader"), "first", "copies")
    rows = local.drop("body", "copies").join(shared, "digest", "left_semi")
    weights = rows.groupBy("leader").agg(F.count("*").alias("rows"))
    return attach_by_key(rows, by_leader.join(weights, "leader"), ["leader"], "rows")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    digest: Callable[[bytes], bytes] = sha256,
    stretch_bytes: int = 32 << 20,
) -> DataFrame:
    """Each row of ``docs`` as: id, keep_id (id of the row that stays), group_size, kept, digest (binary), and, if ``carry``
    names columns, a struct ``carried`` of them. A task combines about ``stretch_bytes`` at a time.
    """
    carried = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("at"),
        F.length(text).cast("long").alias("chars"),
        text.cast("binary").alias("text"),
        *carried,
    )
    schema = T.StructType([f for f in rows.schema.fields if f.name != "text"])
    for name, kind in (("digest", "binary"), ("leader", "long"), ("body", "binary"), ("copies", "long")):
        schema = schema.add(name, kind)
    local = staged(rows.mapInArrow(_combining(digest, stretch_bytes), schema), "stretches")
    classes = staged(_classes(local), "classes")
    by_digest = classes.groupBy("digest").agg(
        F.min("first").alias("first"), F.sum("copies").alias("copies"), F.count("*").alias("texts"), F.sum("copies").alias("rows")
    )
    shared = by_digest.where("texts > 1").select("digest")
    members = local.drop("body", "copies")
    if shared.limit(1).count():
        members = members.join(shared, "digest", "left_anti")
        by_digest = by_digest.where("texts = 1")
        found = attach_by_key(members, by_digest.drop("texts"), ["digest"], "rows").unionByName(_by_text(local, classes, shared))
    else:
        found = attach_by_key(members, by_digest.drop("texts"), ["digest"], "rows")
    return found.select(
        "id",
        F.col("first.id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("first.at") == F.col("at")).alias("kept"),
        "digest",
        *(["carried"] if carry else []),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    return exact_groups(docs, id_col, text_col, docs.columns).where("kept").select("carried.*")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP13_SQL = r"""
WITH d AS (
    SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS place, length(coalesce(text, '')) AS chars,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
    FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       (first_value(place) OVER w) = place AS kept,
       sha256(body) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST, place)
"""
