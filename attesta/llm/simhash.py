"""SimHash near-duplicates by Golay-code fuzzy hashing.

A document's fingerprint takes the majority of every bit over the 64-bit hashes of its word shingles, repeats included. Two
documents are linked when their fingerprints differ in at most two bits.

1. Equal fingerprints form a class; only distinct fingerprints are searched.
2. Pigeonhole: of three segments of a fingerprint one has no error, and all errors are in the other bits. So a pair has
   one segment in common, and in the 23 bits that follow it at most two errors.
3. Those 23 bits are decoded with the perfect binary Golay code. Every word is within three bits of exactly one codeword;
   a word at distance three has five more codewords at distance four. A word's keys are all codewords within four bits:
   one or six. Two words that differ in at most two bits share a key: a word between them has its nearest codeword
   within three bits, which is within four of both.
4. Fingerprints are posted under (segment, segment bits, codeword). Postings of up to SMALL members are joined with
   themselves and each pair is verified on all 64 bits.
5. Families of copies fill larger postings with fingerprints that are close to each other. Their members are verified by
   midpoints instead: two fingerprints differ in at most two bits exactly when some point is within one bit of both. Each member
   is posted under the 65 points within one bit of it; no point has more than 65 members, all of them linked, and
   one link to the smallest keeps them together. So the work grows with the members and not with their pairs.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import query, table
from attesta.llm.minhash import components
from attesta.session import stored

BITS = 64
ERRORS = 2
SEED = 42
SEGMENTS = ((0, 21), (21, 21), (42, 22))  # (first bit, bits)
CODE = 23  # length of the code; 12 bits of it carry the codeword's index
GENERATOR = 0b101011100011  # fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
SMALL = 16
PIECE = 1 << 20  # bytes of text worked on at a time
U = np.uint64


# Fingerprints


def _words(text: bytes):
    """Lists of folded words of a text, in windows of bounded size."""
    first = 0
    while len(text) - first > PIECE:
        last = first + PIECE
        while last < len(text) and text[last] not in b" \t\n\x0b\x0c\r":
            last += 1
        yield text[first:last].lower().split()
        first = last
    yield text[first:].lower().split()


def _hashes(text: bytes, size: int):
    """Arrays of the hashes of a text's shingles, repeats included."""
    from xxhash import xxh64_intdigest

    held: list[bytes] = []
    full = False
    for found in _words(text):
        held += found
        if len(held) >= size:
            full = True
            runs = [held[k:] for k in range(size)]
            yield np.fromiter((xxh64_intdigest(b" ".join(s), SEED) for s in zip(*runs, strict=False)), U, len(held) - size + 1)
            held = held[len(held) - size + 1 :]
    if held and not full:
        yield np.array([xxh64_intdigest(b" ".join(held), SEED)], U)


def fingerprint(text: bytes, size: int = 3) -> int:
    """Majority of every bit over the shingles' hashes; 0 for a text without words."""
    ones, n = np.zeros(BITS, np.int64), 0
    for h in _hashes(text, size):
        for k in range(0, len(h), 1 << 14):
            part = h[k : k + (1 << 14)]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return sum(1 << b for b in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """(id, fingerprint) of every row, the fingerprint as a signed 64-bit number. Null texts count as empty."""

    def run(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(t, size) for t in batch.column(1).to_pylist()), U, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fingerprint"])

    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[key].dataType.simpleString()}, fingerprint long")


# The code


@cache
def codewords() -> np.ndarray:
    """The 4,096 codewords by index: multiples of the generator polynomial."""
    index = np.arange(1 << 12, dtype=np.int64)
    out = np.zeros(1 << 12, dtype=np.int64)
    for k in range(12):
        out ^= np.where((index >> k) & 1, GENERATOR << k, 0)
    return out


@cache
def _decoder() -> tuple[np.ndarray, np.ndarray]:
    """Per syndrome (word modulo the generator): its error of at most three bits, and up to five errors of four bits."""
    singles = [1 << k for k in range(CODE)]
    light = [0, *singles, *(a | b for k, a in enumerate(singles) for b in singles[:k])]
    three = [a | b | c for k, a in enumerate(singles) for j, b in enumerate(singles[:k]) for c in singles[:j]]
    four = [a | b for a in three for b in singles if b < a & -a]
    near = np.zeros(1 << 11, dtype=np.int64)
    near[syndromes(np.array(light + three))] = light + three
    far = np.zeros((1 << 11, 5), dtype=np.int64)
    at = syndromes(np.array(four))
    order = np.argsort(at, kind="stable")
    at, values = at[order], np.array(four)[order]
    place = np.arange(len(at)) - np.searchsorted(at, at)
    far[at, place] = values
    return near, far


def syndromes(words: np.ndarray) -> np.ndarray:
    """Words modulo the generator polynomial: 0 for codewords."""
    rest = words.copy()
    for k in range(CODE - 1, 10, -1):
        rest = np.where((rest >> k) & 1, rest ^ (GENERATOR << (k - 11)), rest)
    return rest


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the word, codeword) for all codewords within four bits of every 23-bit word: one or six each."""
    near, far = _decoder()
    s = syndromes(words)
    first = words ^ near[s]
    more = np.flatnonzero(far[s, 0] != 0)
    others = words[more, None] ^ far[s[more]]
    return np.concatenate([np.arange(len(words)), np.repeat(more, 5)]), np.concatenate([first, others.ravel()])


def postings(found: DataFrame) -> DataFrame:
    """(value, fp): every distinct fingerprint under each of its keys.

    A codeword is a multiple of the generator, so its top 12 bits tell which it is; with the segment's bits and the segment's
    number they make one 64-bit value.
    """

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(U)
            owners, values = [], []
            for n, (first, size) in enumerate(SEGMENTS):
                exact = (fp >> U(first)) & U((1 << size) - 1)
                after = (first + size) % BITS
                turned = (fp >> U(after)) | (fp << U(BITS - after)) if after else fp
                owner, code = keys((turned & U((1 << CODE) - 1)).astype(np.int64))
                owners.append(owner)
                values.append((n << 40) | ((code >> 11) << 22) | exact[owner].astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(values)), pa.array(fp[np.concatenate(owners)].view(np.int64))], names=["value", "fp"])

    return found.select("fp").mapInArrow(run, "value long, fp long")


def differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(found: DataFrame, small: int = SMALL) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that differ in at most two bits.

    All pairs are linked that meet in small postings; those in larger ones keep their connection through midpoints, not every pair.
    """
    posted = stored(postings(found), "codewords")
    held = posted.groupBy("value").agg(F.count("*").alias("held")).filter("held > 1")
    known = stored(posted.join(held, "value"), "shared-codewords")
    few = known.filter(F.col("held") <= small)
    pairs = few.select("value", F.col("fp").alias("a")).join(few.select("value", F.col("fp").alias("b")), "value")
    near = pairs.filter((F.col("a") < F.col("b")) & (differing("a", "b") <= ERRORS)).select("a", "b")
    crowd = known.filter(F.col("held") > small).select("fp").distinct()
    points = crowd.select("fp", F.explode(F.array(F.lit(0).cast("long"), *[F.lit(1 << k if k < 63 else -(1 << 63)) for k in range(BITS)])).alias("flip"))
    points = points.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    hubs = points.groupBy("point").agg(F.min("fp").alias("hub"), F.count("*").alias("held")).filter("held > 1").drop("held")
    met = points.join(hubs, "point").filter("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b"))
    return near.unionByName(met).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """One row per row of ``docs``: (id, fingerprint, component_id).

    ``fingerprint`` is 16 lowercase hex digits. Documents are linked when their fingerprints differ in at most two bits;
    ``component_id`` is the smallest id reachable. Words are runs between ASCII blanks, A-Z lowered; a text of fewer words
    than ``size`` has its whole sequence as its only shingle. Null, empty and word-less texts have fingerprint zero, which
    links like any other. The nodes are fingerprints: rows that share an id each go by their own text. Rows without an id have a
    component if a row with an id is in it, else null; they lend their id to nobody but link as others do. Only the two named
    columns are read, so no other name can clash. Empty tables give no rows.
    """
    rows = stored(fingerprints(docs, key, text, size), "fingerprints")
    classes = stored(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("id").alias("least")), "fingerprint-classes")
    joined = components(links(classes))
    named = classes.join(joined.select(F.col("id").alias("fp"), "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    told = named.join(least, "component").select("fp", "component_id")
    found = rows.join(told, rows["fingerprint"] == told["fp"], "left")
    return found.select("id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("op13_golay_simhash")
def op13_golay_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumnRenamed("id", "doc_id")
