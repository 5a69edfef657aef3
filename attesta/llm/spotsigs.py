"""SpotSigs document fingerprints.

A spot is a common word (an anchor); its signature is the anchor and the chain of the next content words, DISTANCE apart.
A document's fingerprint is the set of its spot signatures, as 64-bit hashes. Texts with words but no spot get one
signature from all their words; texts without words have none.

Fingerprints are compared in partitions by set length: two sets whose lengths differ by more than the wanted similarity
allows cannot be near, so a set meets only its own length band and the next. Inside a band sets are posted under the
rarest of their signatures (a prefix that two near sets share), and Jaccard stops as soon as the signatures left cannot
reach the threshold.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm.common import partitions, query, table
from attesta.llm.wordhash import U, buffers, mix, words
from attesta.session import stored

CHAIN = 2  # content words after an anchor
DISTANCE = 1

# Common words that anchor a spot, and the further common words that are no content.
ANCHORS = (
    "the", "a", "an", "is", "was", "of", "to", "be", "and", "in",
    "le", "la", "les", "un", "une", "est", "des", "et", "de", "que",
    "der", "die", "das", "ein", "eine", "ist", "und", "von", "zu", "den",
    "el", "los", "las", "una", "es", "del", "y", "en", "con", "lo",
)
COMMON = (
    "that", "it", "for", "on", "with", "as", "at", "by", "from", "this", "or", "are", "were", "not", "but", "have", "has", "had", "they", "you",
    "qui", "pour", "dans", "sur", "par", "au", "aux", "il", "elle", "ne", "pas", "ce", "se", "du",
    "mit", "auf", "für", "im", "dem", "des", "nicht", "sich", "auch", "als", "an", "es", "so",
    "por", "para", "se", "su", "al", "mi", "no", "como", "más",
)


def _hashes(listed) -> np.ndarray:
    column = pa.array(sorted(set(listed)), pa.string())
    return np.sort(words(*buffers(column))[0])


def spot_signatures(column: pa.Array, chain: int = CHAIN, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct signatures, offsets) of every text of a string column. Punctuation stays part of a word."""
    n = len(column)
    h, owner = words(*buffers(column))
    anchor = np.isin(h, _hashes(ANCHORS))
    content = np.flatnonzero(~anchor & ~np.isin(h, _hashes(COMMON)))
    spots = np.flatnonzero(anchor)
    after = np.searchsorted(content, spots)
    last = after + (chain - 1) * distance
    fits = last < len(content)
    spots, after, last = spots[fits], after[fits], last[fits]
    fits = owner[content[last]] == owner[spots] if len(last) else np.zeros(0, bool)
    spots, after = spots[fits], after[fits]
    with np.errstate(over="ignore"):
        s = h[spots].copy()
        for k in range(chain):
            s = mix(s * U(3) + h[content[after + k * distance]])
        own = owner[spots]
        # Texts with words and no spot: one signature of the whole sequence.
        counts = np.bincount(owner, minlength=n)
        bare = np.flatnonzero((counts > 0) & (np.bincount(own, minlength=n) == 0))
        if len(bare):
            ends = np.cumsum(counts)
            whole = np.array([int.from_bytes(hashlib.blake2b(h[ends[d] - counts[d] : ends[d]].tobytes(), digest_size=8).digest(), "little") for d in bare], dtype=U)
            s, own = np.concatenate([s, whole]), np.concatenate([own, bare])
    order = np.lexsort((s, own))
    s, own = s[order], own[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (own[1:] != own[:-1])
    s, own = s[new], own[new]
    return s, np.concatenate([[0], np.cumsum(np.bincount(own, minlength=n))]).astype(np.int64)


def digest(signatures: np.ndarray) -> str:
    """A fingerprint as a string: how many signatures, and a hash of the sorted set."""
    return f"{len(signatures)}:{hashlib.blake2b(signatures.tobytes(), digest_size=16).hexdigest()}"


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; two empty ones are alike."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def pruned_likeness(a: np.ndarray, b: np.ndarray, least: float) -> float | None:
    """``likeness`` where it reaches ``least``; None as soon as the signatures still to come cannot reach it."""
    low, high = sorted((len(a), len(b)))
    if low < least * high:
        return None
    need = math.ceil(least / (1 + least) * (low + high) - 1e-9)
    both, step, at = 0, 64, 0
    while at < len(a):
        both += int(np.isin(a[at : at + step], b, assume_unique=True).sum())
        at += step
        if both + max(0, len(a) - at) < need:
            return None
    value = likeness(a, b)
    return value if value >= least else None


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint, n_signatures, signatures) of every row; null text is empty and has no signatures."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            s, offsets = spot_signatures(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(s.view(np.int64)))
            prints = [digest(s[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string()), pa.array(np.diff(offsets)), lists], names=["id", "fingerprint", "n_signatures", "signatures"])

    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, fingerprint string, n_signatures long, signatures array<bigint>")


def near_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """((id, class), (a, b, likeness)): documents by class of equal fingerprints, and the near pairs of class representatives.

    A class's smallest id stands for it. Copies are not expanded into pairs and no link between different fingerprints is lost.
    Rows without an id or without words have no class and no pairs.
    """
    prints = stored(fingerprints(docs, key, text).filter("id IS NOT NULL AND n_signatures > 0"), "fingerprints")
    classes = prints.groupBy("fingerprint").agg(F.min("id").alias("class"))
    members = prints.select("id", "fingerprint").join(classes, "fingerprint").select("id", "class")
    reps = prints.join(classes.select(F.col("fingerprint").alias("_f"), "class"), (F.col("fingerprint") == F.col("_f")) & (F.col("id") == F.col("class")), "left_semi").dropDuplicates(["fingerprint"])
    reps = stored(reps.withColumn("band", F.floor(F.log("n_signatures") / F.lit(-math.log(least)))), "bands")
    spread = reps.select("id", "n_signatures", "band", F.explode("signatures").alias("s"))
    held = spread.groupBy("s").agg(F.count("*").alias("held")).filter("held > 1")
    # Unique signatures come first in the order of rarity; the prefix is what is left of it after them.
    ranked = spread.join(held, "s").groupBy("id", "n_signatures", "band").agg(F.sort_array(F.collect_list(F.struct("held", "s"))).alias("shared"))
    need = F.ceil(F.col("n_signatures") * least - 1e-9)
    prefix = F.transform(F.slice("shared", 1, F.greatest(F.lit(0), F.size("shared") - need + 1).cast("int")), lambda x: x["s"])
    posted = ranked.select("id", "n_signatures", "band", prefix.alias("prefix")).withColumn("s", F.explode("prefix"))
    a = posted.select("s", F.col("band").alias("band"), F.col("id").alias("a"), F.col("n_signatures").alias("n_a"), F.col("prefix").alias("p_a"))
    b = posted.select("s", F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1)).alias("band"), F.col("id").alias("b"), F.col("n_signatures").alias("n_b"), F.col("prefix").alias("p_b"))
    once = F.element_at(F.array_intersect("p_a", "p_b"), 1) == F.col("s")
    fits = (F.col("n_a") >= F.col("n_b") * least) & (F.col("n_b") >= F.col("n_a") * least)
    pairs = a.join(b, ["s", "band"]).filter((F.col("a") < F.col("b")) & fits & once).select("a", "b")
    left = reps.select(F.col("id").alias("a"), F.col("signatures").alias("s_a"))
    right = reps.select(F.col("id").alias("b"), F.col("signatures").alias("s_b"))
    kind = docs.schema[key].dataType.simpleString()

    def compare(batches):
        for batch in batches:
            lists = [[np.sort(np.asarray(x, dtype=np.int64)) for x in batch.column(k).to_pylist()] for k in (2, 3)]
            values = [pruned_likeness(x, y, least) for x, y in zip(*lists, strict=True)]
            keep = pa.array([v is not None for v in values], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values, pa.float64())], names=["a", "b", "likeness"]).filter(keep)

    near = pairs.join(left, "a").join(right, "b").select("a", "b", "s_a", "s_b").mapInArrow(compare, f"a {kind}, b {kind}, likeness double")
    return members, near


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The next document is that with the next smaller key, after the last the first; a null key comes last. Its first half
    replaces the last half of a text. Rows are range-sorted by key, so neighbours meet in one task; only each task's first row
    goes to the task before it, one row per task. Rows with equal keys are ordered by text.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = F.col("id").desc_nulls_last()
    ordered = rows.repartitionByRange(partitions(spark), order).sortWithinPartitions(order, "text")
    facts = f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def compared(ids: pa.Array, texts: list[str], following: list[str]) -> pa.RecordBatch:
        """Facts of texts, each with the text that follows it."""
        edited = [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for t, f in zip(texts, following, strict=True)]
        own, edit, nxt = (_split(spot_signatures(pa.array(x, pa.large_string()))) for x in (texts, edited, following))
        columns = [
            ids,
            pa.array(map(len, texts), pa.int64()),
            pa.array([hashlib.sha256(e.encode("utf-8")).hexdigest() for e in edited], pa.string()),
            pa.array(map(digest, own), pa.string()),
            pa.array(map(digest, edit), pa.string()),
            pa.array(map(likeness, own, edit), pa.float64()),
            pa.array(map(likeness, own, nxt), pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def edge(id_: pa.Array, text_: str, side: str, part: int) -> pa.RecordBatch:
        blank = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
        return pa.RecordBatch.from_arrays([id_, *blank, pa.array([part], pa.int32()), pa.array([side]), pa.array([text_], pa.string())], names=names)

    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "part", "side", "text"]

    def inside(batches):
        part, held = TaskContext.get().partitionId(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            if held is None:
                yield edge(ids.slice(0, 1), texts[0], "first", part)
            else:
                ids, texts = pa.concat_arrays([held[0], ids]), [held[1], *texts]
            if len(texts) > 1:
                done = compared(ids.slice(0, len(texts) - 1), texts[:-1], texts[1:])
                empty = [pa.nulls(done.num_rows, t) for t in (pa.int32(), pa.string(), pa.string())]
                yield pa.RecordBatch.from_arrays([*done.columns, *empty], names=names)
            held = ids.slice(len(texts) - 1), texts[-1]
        if held is not None:
            yield edge(held[0], held[1], "last", part)

    def edges(batches):
        for batch in batches:
            yield compared(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist())

    made = stored(ordered.mapInArrow(inside, f"{facts}, part int, side string, text string"), "neighbours")
    # Two rows per task from here on.
    firsts = made.filter("side = 'first'").select("part", F.col("text").alias("following"))
    parts = firsts.select("part")
    after = parts.select(F.col("part").alias("part"), F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next_part"))
    lasts = made.filter("side = 'last'").select("part", "id", "text").join(after, "part").join(firsts.withColumnRenamed("part", "next_part"), "next_part")
    ends = lasts.select("id", "text", "following").mapInArrow(edges, facts)
    return made.filter("side IS NULL").drop("part", "side", "text").unionByName(ends)


def _split(found: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    values, offsets = found
    return [values[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


@query("op4_spotsigs")
def op4_spotsigs(spark, sf_dir):
    found = edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumnRenamed("id", "doc_id")
