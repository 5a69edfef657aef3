"""Token ids in Parquet list columns.

Documents are range-sorted by id, encoded and written as one row each: id, the place of its first token in its file, its
token count and the list of ids. Ids are dictionary-encoded, counts and places delta-encoded; row groups and pages have
set sizes and column indexes, so reading a few documents or only the counts touches a few pages.

Encoding uses the tokenizers library on distinct pre-tokens: a text is cut into pre-tokens with array operations over its
code points, the distinct new ones are encoded by the library's model and the ids are gathered. A hash finds a pre-token that was
seen before; its characters are then compared, and where they differ it is encoded by itself. Byte-level merges never
cross pre-tokens, so the ids equal those of the library on the whole text, which the tests compare.
"""

from __future__ import annotations

import unicodedata
import uuid
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attesta.llm.common import partitions, query, table
from attesta.llm.wordhash import U, mix
from attesta.session import checkpoint_folder

END = 0
PIECE = 1 << 20  # code points worked on at a time
KNOWN = 2_000_000  # distinct pre-tokens a worker remembers
KNOWN_CHARACTERS = 16 << 20  # and their characters
BASE = 0x9E3779B97F4A7C15  # of the hash that finds a pre-token; odd, so it has an inverse modulo 2^64
FORMAT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",  # delta encoding for what has no dictionary
    "parquet.enable.dictionary": "true",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "200",
}
LETTER, NUMBER, SPACE, OTHER, ODD = 1, 2, 3, 0, 4


@cache
def _classes() -> np.ndarray:
    """Class of every code point; ODD where Unicode versions may differ about letters, numbers and spaces."""
    out = np.zeros(0x110000, dtype=np.uint8)
    old = unicodedata.ucd_3_2_0
    for cp in range(0x110000):
        ch = chr(cp)
        kind = unicodedata.category(ch)
        value = LETTER if kind[0] == "L" else NUMBER if kind[0] == "N" else OTHER
        if kind == "Cn" or (value and old.category(ch) == "Cn"):
            value = ODD
        out[cp] = value
    for cp in (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
        out[cp] = SPACE
    out[0x3400:0x4DB6] = out[0x4E00:0x9FA6] = out[0xAC00:0xD7A4] = LETTER
    return out


@cache
def _byte_marks() -> dict[int, str]:
    """The printable characters that stand for bytes in byte-level vocabularies, by their rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    marks = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in marks):
        marks[b] = chr(256 + n)
    return marks


def pretoken_starts(cp: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each code point of one text without ODD ones.

    Runs of letters, of numbers and of other characters, each with one blank before it; the rest of a white run apart;
    an apostrophe that starts a token with s, t, m, d, re, ve or ll.
    """
    n = len(cp)
    start = np.ones(n, dtype=bool)
    start[1:] = kinds[1:] != kinds[:-1]
    space = kinds == SPACE
    # The last character of a white run before more text is apart from the run, and a blank joins what follows.
    last = np.flatnonzero(space[:-1] & ~space[1:])
    start[last] = True
    blank = last[cp[last] == 32]
    start[blank + 1] = False
    quote = np.flatnonzero((cp == 39) & start)
    if len(quote):
        nxt = np.concatenate([cp, [0, 0, 0]])
        a, b = nxt[quote + 1], nxt[quote + 2]
        one = np.isin(a, [ord("s"), ord("t"), ord("m"), ord("d")])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        for found, length in ((quote[one], 2), (quote[two & ~one], 3)):
            start[found + 1] = False
            after = found + length
            start[after[after < n]] = True
    return start


class Encoder:
    """Encodes texts with a byte-level BPE file of the tokenizers library, remembering pre-tokens it has seen."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        marks = _byte_marks()
        self.marks = {b: marks[b] for b in range(256)}
        self._forget()

    def _forget(self):
        none = np.zeros(0, np.int64)
        self.hashes, self.begins, self.sizes, self.flat = np.zeros(0, U), none, none, np.zeros(0, np.int32)
        self.spelt, self.lengths, self.characters = none, none, np.zeros(0, np.uint32)  # where the characters of each begin, how many, and all of them

    def _ids(self, string: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(string.encode().decode("latin-1").translate(self.marks))]

    def _learn(self, hashes: np.ndarray, strings: list[str]):
        if len(self.hashes) + len(hashes) > KNOWN or len(self.characters) > KNOWN_CHARACTERS:
            self._forget()
        ids = list(map(self._ids, strings))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        begins, spelt = len(self.flat) + np.cumsum(sizes) - sizes, len(self.characters) + np.cumsum(lengths) - lengths
        self.flat = np.concatenate([self.flat, np.fromiter((i for x in ids for i in x), np.int32, int(sizes.sum()))])
        self.characters = np.concatenate([self.characters, np.frombuffer("".join(strings).encode("utf-32-le"), dtype=np.uint32)])
        columns = (self.hashes, hashes), (self.begins, begins), (self.sizes, sizes), (self.spelt, spelt), (self.lengths, lengths)
        joined = [np.concatenate(c) for c in columns]
        order = np.argsort(joined[0])
        self.hashes, self.begins, self.sizes, self.spelt, self.lengths = (c[order] for c in joined)

    def _pieces(self, text: str):
        """Cuts before white runs, where a pre-token always starts."""
        first = 0
        while len(text) - first > PIECE:
            cut = first + PIECE
            while cut < len(text) and not (text[cut] == " " and not text[cut - 1].isspace()):
                cut += 1
            yield text[first:cut]
            first = cut
        yield text[first:]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, without special tokens of its own."""
        out: list = [[] for _ in texts]
        wave, size = [], 0
        for k, text in enumerate(texts):
            if any(s in text for s in self.special):
                out[k].append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.int32))
                continue
            for piece in self._pieces(text):
                wave.append((k, piece))
                size += len(piece)
                if size >= PIECE:
                    self._wave(wave, out)
                    wave, size = [], 0
        self._wave(wave, out)
        return [x[0] if len(x) == 1 else np.concatenate(x) if x else np.zeros(0, np.int32) for x in out]

    def _wave(self, wave, out):
        classes = _classes()
        whole = "\x00".join(p for _, p in wave)
        if not whole:
            return
        cp = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
        kinds = classes[cp]
        if (kinds == ODD).any():
            # Only texts with characters that Unicode versions judge differently go whole to the library.
            keep = []
            for k, p in wave:
                if (classes[np.frombuffer(p.encode("utf-32-le"), dtype=np.uint32)] == ODD).any():
                    out[k].append(np.array(self.tokenizer.encode(p, add_special_tokens=False).ids, dtype=np.int32))
                else:
                    keep.append((k, p))
            return self._wave(keep, out)
        lengths = np.array([len(p) for _, p in wave])
        ends = np.cumsum(lengths + 1) - 1  # the zero after each piece
        begins = ends - lengths
        # Each piece is a text of its own: the zero between two has a class that nothing joins.
        kinds = kinds.copy()
        kinds[ends[:-1]] = 9
        start = pretoken_starts(cp, kinds)
        # A white run at the end of a piece stays whole.
        for b, e in zip(begins.tolist(), ends.tolist(), strict=True):
            if e > b and kinds[e - 1] == SPACE:
                run = e - 1
                while run > b and kinds[run - 1] == SPACE:
                    run -= 1
                start[run + 1 : e] = False
            if e < len(start):
                start[e] = True
                if e + 1 < len(start):
                    start[e + 1] = True
        token = np.flatnonzero(start)
        stop = np.append(token[1:], len(cp))
        token_is_text = kinds[token] != 9
        token, stop = token[token_is_text], stop[token_is_text]
        up, down = _powers_of(len(cp))
        with np.errstate(over="ignore"):
            run = np.concatenate([[U(0)], np.cumsum((cp.astype(U) + U(1)) * up[: len(cp)])])
            h = mix((run[stop] - run[token]) * down[token] + (stop - token).astype(U) * U(0xD6E8FEB86659FD93))
        distinct, at, back = np.unique(h, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, distinct)
        new = (place == len(self.hashes)) | (self.hashes[np.minimum(place, max(0, len(self.hashes) - 1))] != distinct) if len(self.hashes) else np.ones(len(distinct), bool)
        if new.any():
            before = len(self.hashes)
            self._learn(distinct[new], [whole[a:b] for a, b in zip(token[at[new]].tolist(), stop[at[new]].tolist(), strict=True)])
            if len(self.hashes) < before + int(new.sum()):  # it has forgotten the rest of this wave's
                old = distinct[~new]
                self._learn(old, [whole[a:b] for a, b in zip(token[at[~new]].tolist(), stop[at[~new]].tolist(), strict=True)])
            place = np.searchsorted(self.hashes, distinct)
        sizes, first, flat = self.sizes[place][back], self.begins[place][back], self.flat
        wrong = self._unlike(cp[kinds != 9], stop - token, place[back])
        if len(wrong):
            # Another pre-token has the hash: these are encoded by themselves.
            own = [self._ids(whole[a:b]) for a, b in zip(token[wrong].tolist(), stop[wrong].tolist(), strict=True)]
            sizes[wrong] = lengths = np.fromiter(map(len, own), np.int64, len(own))
            first[wrong] = len(flat) + np.cumsum(lengths) - lengths
            flat = np.concatenate([flat, np.fromiter((i for x in own for i in x), np.int32, int(lengths.sum()))])
        ends_at = np.cumsum(sizes)
        ids = flat[np.repeat(first - (ends_at - sizes), sizes) + np.arange(int(ends_at[-1]) if len(ends_at) else 0)]
        bounds = np.concatenate([[0], ends_at])[np.searchsorted(token, np.append(begins, len(cp)))]
        for j, (k, _) in enumerate(wave):
            out[k].append(ids[bounds[j] : bounds[j + 1]])


    def _unlike(self, text: np.ndarray, lengths: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Which pre-tokens, whose characters are ``text`` one after the other, are spelt unlike the known one at ``place``."""
        odd = self.lengths[place] != lengths
        ends = np.cumsum(lengths)
        at = np.repeat(self.spelt[place] - (ends - lengths), lengths) + np.arange(len(text))
        differ = np.flatnonzero(self.characters[np.minimum(at, len(self.characters) - 1)] != text)
        odd[np.searchsorted(ends, differ, side="right")] = True
        return np.flatnonzero(odd)


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


@cache
def _powers(bits: int):
    n = 1 << bits
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.concatenate([[U(1)], np.full(n, U(b))])) for b in (BASE, pow(BASE, -1, 1 << 64)))


def _powers_of(n: int):
    return _powers(max(21, int(n).bit_length()))


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, key: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text and write the files in ascending order of ``key``; each document ends with id 0.

    Null and empty texts hold only the end id. Rows without a key come first. Rows that repeat a key are documents of their
    own, ordered by text. Only the two named columns are read, so no other name can clash; an empty table gives a
    folder without documents.
    """

    def run(batches):
        part = TaskContext.get().partitionId()
        encoder, done = _encoder(vocabulary), 0
        for batch in batches:
            texts = batch.column(1).to_pylist()
            first = 0
            while first < len(texts):
                # Lists of a bounded number of code points go out together.
                last, size = first, 0
                while last < len(texts) and (last == first or size + len(texts[last]) <= 2 * PIECE):
                    size += len(texts[last])
                    last += 1
                ids = encoder.encode(texts[first:last])
                counts = np.array([len(x) + 1 for x in ids], dtype=np.int64)
                ends = np.cumsum(counts)
                flat = np.full(int(ends[-1]), END, dtype=np.int32)
                keep = np.ones(len(flat), dtype=bool)
                keep[ends - 1] = False
                flat[keep] = np.concatenate(ids)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(np.full(last - first, part, np.int32)), pa.array(done + ends - counts), pa.array(counts), lists], names=["key", "part", "place", "n_tokens", "ids"]
                )
                done += int(ends[-1])
                first = last

    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(partitions(spark), "key").sortWithinPartitions("key", "text")
    kind = docs.schema[key].dataType.simpleString()
    ordered.mapInArrow(run, f"key {kind}, part int, place long, n_tokens long, ids array<int>").write.options(**FORMAT).parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(key, part, place, start, n_tokens, ids); ``start`` counts the ids of all documents before. Unused columns are not read."""
    rows = spark.read.parquet(folder)
    # One row per file.
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = files.select(F.col("part").alias("_part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("_before"))
    return rows.join(before, F.col("part") == F.col("_part")).select("key", "part", "place", (F.col("_before") + F.col("place")).alias("start"), "n_tokens", "ids")


def checksums(batches):
    """Unsigned crc32 of every document's ids as little-endian unsigned 32-bit integers."""
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("ids"))
        flat = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False).astype("<u4"))
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros(0, int)
        view = memoryview(flat).cast("B") if len(flat) else memoryview(b"")
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        crc = [zlib.crc32(view[4 * int(a) : 4 * int(b)]) for a, b in zip(begins, ends, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(np.append(begins, ends[-1:])) if len(ends) else ends, pa.int64()), pa.array(crc, pa.int64())], names=["key", "part", "place", "n_tokens", "ids_crc32"])


@query("op2_token_ids")
def op2_token_ids(spark, sf_dir):
    import public_tokenizers

    folder = f"{checkpoint_folder(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    write_tokens(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    crc = spark.read.parquet(folder).select("key", "part", "place", "ids").mapInArrow(checksums, f"key {kind}, part int, place long, n_tokens long, ids_crc32 long")
    files = read_tokens(spark, folder).groupBy("part").agg(F.min(F.col("start") - F.col("place")).alias("before"))
    return crc.join(files, "part").select(F.col("key").alias("doc_id"), (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
