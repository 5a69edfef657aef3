"""Alignment of two tokenizers over one text: a byte-level BPE (A) and a piece model with byte fallback (B).

Both tokenize the text with one blank before it. Byte offsets where tokens of both end cut them into groups.

Spans give the coarse cuts: the character offsets of the tokenizers library for A, the byte spans of the sentencepiece library's
result proto for B (the immutable proto, under its present name). A span is only as fine as a character: the tokens
inside a character of several bytes share its offsets, and byte-fallback pieces have an empty span but for the last. Such
tokens are refined with their decoded bytes. A text whose decoded tokens are not its own bytes has no alignment.

A text is cut before each blank that follows a character other than white space. No pre-token of A and no piece of B goes
across such a point, so the parts' tokens are those of the whole text, and both tokenizers end a token there. Each
distinct part is tokenized and aligned once per worker while its memory holds it.

Corpus counts of linked id pairs come in two steps, so no table that grows with the corpus is broadcast. Rows are gathered in
blocks of bounded size; each block has its distinct pairs with their counts. Totals over blocks go back to the blocks that hold the pair,
and a block and its rows meet once more. A frequent pair is one row per block, however many links have it.
"""

from __future__ import annotations

import re
from functools import cache
from hashlib import sha256
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import query, table
from attesta.llm.pieces import MARK
from attesta.llm.tokenids import _byte_marks
from attesta.session import stored

KNOWN = 800_000  # parts a worker remembers, some 350 bytes each
KNOWN_BYTES = 64 << 20  # and the characters of their groups
WINDOW = 1 << 19  # characters worked on at a time
TOGETHER = 128  # parts tokenized as one text
ALIGNED = 4096  # parts aligned in one call
BLOCK = 1 << 21  # links of a block
SHIFT = 32
NEW, BAD = -2, -1  # places of parts that are not known, and of parts whose tokens' bytes are not their own
# A part ends where a blank with more text after it follows a character that is no white space.
PARTS = re.compile(r"(?s) \S+(?= .)| .*?\S(?= .)| .+| ")
CUT = re.compile(r"(?s)\S(?= .)")


class Grown:
    """An array that values are appended to."""

    def __init__(self, kind):
        self.held, self.size = np.zeros(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        last = self.size + len(values)
        if last > len(self.held):
            self.held = np.concatenate([self.held, np.zeros(max(last, 2 * len(self.held)) - len(self.held), self.held.dtype)])
        self.held[self.size : last] = values
        self.size = last


def spread(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of runs, one run after the other."""
    ends = np.cumsum(counts)
    return np.repeat(begins - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


class Aligner:
    """Aligns texts of two vocabulary files, remembering the parts it has seen."""

    def __init__(self, byte_level: str, piece_model: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        marks = {mark: byte for byte, mark in _byte_marks().items()}
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        known = {i: t.encode() if t in special else bytes(marks[ch] for ch in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.a_bytes = [known.get(i, b"") for i in range(max(known) + 1)]
        model = sentencepiece_model_pb2.ModelProto()
        with open(piece_model, "rb") as f:
            model.ParseFromString(f.read())
        self.b_bytes = [bytes([int(p.piece[3:5], 16)]) if p.type == 6 else p.piece.replace(MARK, " ").encode() for p in model.pieces]
        self.blank = self.b.piece_to_id(MARK)
        # Parts are tokenized apart only if no piece holds a blank after another character; else texts stay whole.
        self.apart = not any(MARK in p.piece.lstrip(MARK) for p in model.pieces)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in table]) for table in (self.a_bytes, self.b_bytes))
        # Decimal names of all ids with room for what follows them.
        names = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.digits = np.array([len(n) for n in names])
        width = int(self.digits.max()) + 1
        self.names = np.frombuffer("".join(n.ljust(width) for n in names).encode(), np.uint8).reshape(-1, width)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.spelt = 0
        # Per part: tokens of A and of B, its first group and how many. Per group: bytes and link.
        self.n_a, self.n_b, self.first, self.count = Grown(np.int32), Grown(np.int32), Grown(np.int64), Grown(np.int64)
        self.sizes, self.links = Grown(np.int32), Grown(np.int64)

    def ends_a(self, text: str, ids: np.ndarray, offsets: list[tuple[int, int]]) -> np.ndarray:
        """The byte where each token of A ends."""
        if text.isascii():
            return np.array([end for _, end in offsets], dtype=np.int64)  # characters are bytes, so the offsets are exact
        spans = np.fromiter(chain.from_iterable(offsets), np.int64, 2 * len(offsets)).reshape(-1, 2)
        point = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        width = 1 + (point > 0x7F).astype(np.int64) + (point > 0x7FF) + (point > 0xFFFF)
        ends = np.concatenate([[0], np.cumsum(width)])[spans[:, 1]]
        # The next token starts inside the same character: its decoded bytes tell where this one ends.
        split = np.append(spans[1:, 0] < spans[:-1, 1], False)
        return np.where(split, np.cumsum(self.a_sizes[ids]), ends)

    def ends_b(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The byte where each piece of B ends, of the ends of the spans; these lack the blank before the text."""
        inside = ends == np.concatenate([[0], ends[:-1]])  # byte pieces, all but the last of a character: a span begins where the last one ended
        return np.where(inside, np.cumsum(self.b_sizes[ids]), ends + 1) if inside.any() else ends + 1

    def tokenized(self, texts: list[str]):
        """Per text: ids of A's tokens and B's pieces and the bytes where they end; None where their bytes are not the text's."""
        protos = self.b.encode([t[1:] for t in texts], return_type="proto", num_threads=1)
        bytes_a, bytes_b = self.a_bytes, self.b_bytes
        for text, proto in zip(texts, protos, strict=True):
            encoding = self.a.encode(text, add_special_tokens=False)
            list_a, spans_b = encoding.ids, [(p.id, p.end) for p in proto.pieces]
            if not spans_b:
                spans_b = [(self.blank, 0)]  # the blank alone, at the end of a text
            raw = text.encode()
            if b"".join([bytes_a[i] for i in list_a]) != raw or b"".join([bytes_b[i] for i, _ in spans_b]) != raw:
                yield None
                continue
            ids_a = np.array(list_a, dtype=np.int64)
            ids_b, ends_b = np.fromiter(chain.from_iterable(spans_b), np.int64, 2 * len(spans_b)).reshape(-1, 2).T
            yield ids_a, ids_b, self.ends_a(text, ids_a, encoding.offsets), self.ends_b(ids_b, ends_b)

    def learn(self, parts: list[str]) -> None:
        """Tokenize and align parts, some together as one text."""
        runs = [parts[k : k + TOGETHER] for k in range(0, len(parts), TOGETHER)]
        for run, found in zip(runs, self.tokenized(["".join(r) for r in runs]), strict=True):
            if found is not None:
                self.remember(run, *found)
            elif len(run) == 1:
                self.known[run[0]] = BAD
            else:
                for part in run:
                    self.learn([part])

    def remember(self, parts: list[str], ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> None:
        """Cut the tokens of parts that stand one after the other into groups."""
        # Which tokens end where one of the other tokenizer ends.
        stop = np.zeros((2, int(ends_a[-1]) + 1), bool)
        stop[0, ends_a] = stop[1, ends_b] = True
        both_a, both_b = stop[1, ends_a], stop[0, ends_b]
        cuts, last_a, last_b = ends_a[both_a], np.flatnonzero(both_a), np.flatnonzero(both_b)
        self.links.add(ids_a[last_a] << SHIFT | ids_b[last_b])
        self.sizes.add(np.diff(cuts, prepend=0))
        # A group's A ids, then its B ids, each with what follows it: a comma, a bar, or a semicolon after the group.
        place = np.concatenate([2 * (np.cumsum(both_a) - both_a), 2 * (np.cumsum(both_b) - both_b) + 1])
        order = np.argsort(place, kind="stable")
        place, ids = place[order], np.concatenate([ids_a, ids_b])[order]
        follows = np.where(place == np.append(place[1:], -1), ord(","), np.where(place % 2 == 0, ord("|"), ord(";")))
        digits = self.digits[ids]
        spelt = self.names[ids]
        spelt[np.arange(len(ids)), digits] = follows
        blob = spelt[np.arange(spelt.shape[1]) <= digits[:, None]].tobytes()
        stops = np.searchsorted(cuts, np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in parts])) + 1
        upto_a, upto_b = last_a[stops - 1] + 1, last_b[stops - 1] + 1
        letters = np.cumsum(digits + 1)[upto_a + upto_b - 1].tolist()
        before = len(self.groups)
        self.groups += [blob[x : y - 1] for x, y in zip([0, *letters], letters, strict=False)]
        self.spelt += len(blob)
        self.n_a.add(np.diff(upto_a, prepend=0))
        self.n_b.add(np.diff(upto_b, prepend=0))
        count = np.diff(stops, prepend=0)
        self.first.add(self.links.size - len(cuts) + stops - count)
        self.count.add(count)
        self.known.update(zip(parts, range(before, len(self.groups)), strict=True))

    def look(self, parts: list[str]) -> np.ndarray:
        """Where each part is remembered."""
        if len(self.known) > KNOWN or self.spelt > KNOWN_BYTES:
            self.forget()
        found = np.fromiter(map(self.known.get, parts, repeat(NEW)), np.int64, len(parts))
        new = np.flatnonzero(found == NEW).tolist()
        if new:
            unseen = []
            for p in {parts[k] for k in new}:
                if MARK in p or p[-1].isspace():
                    self.learn([p])  # no bytes of its own, or the end of a text
                else:
                    unseen.append(p)
            for first in range(0, len(unseen), ALIGNED):
                self.learn(unseen[first : first + ALIGNED])
            known = self.known
            found[new] = [known[parts[k]] for k in new]
        return found

    def windows(self, text: str):
        """Lists of the parts of a text."""
        if not self.apart:
            yield [text]
            return
        first = 0
        while first < len(text):
            cut = CUT.search(text, first + WINDOW) if len(text) - first > 2 * WINDOW else None
            last = cut.end() if cut else len(text)
            yield PARTS.findall(text, first) if cut is None else PARTS.findall(text[first:last])
            first = last

    def texts(self, texts: list[str]) -> list[tuple]:
        """(tokens of A, tokens of B, groups as text, bytes of each group, links) of whole texts."""
        pieces, owners = [], []
        for k, text in enumerate(texts):
            for parts in self.windows(" " + text) if text else ():
                pieces.append(parts)
                owners.append(k)
        out: list = [[] for _ in texts]
        first = 0
        while first < len(pieces):
            # Many short texts, or one window of a long one, are looked up together.
            last, size = first, 0
            while last < len(pieces) and (last == first or size + len(pieces[last]) <= WINDOW // 4):
                size += len(pieces[last])
                last += 1
            for k, found in zip(owners[first:last], self.joined(pieces[first:last]), strict=True):
                out[k].append(found)
            first = last
        nothing = (0, 0, "", np.zeros(0, np.int32), np.zeros(0, np.int64))
        whole = []
        for found in out:
            if not found or None in found:
                whole.append(nothing)
            elif len(found) == 1:
                whole.append(found[0])
            else:
                n_a, n_b, groups, sizes, links = zip(*found, strict=True)
                whole.append((sum(n_a), sum(n_b), ";".join(groups), np.concatenate(sizes), np.concatenate(links)))
        return whole

    def joined(self, lists_of_parts: list[list[str]]) -> list:
        """What is known of the parts of each list together; None where a part has no alignment."""
        found = self.look([p for parts in lists_of_parts for p in parts])
        ends = np.cumsum([len(parts) for parts in lists_of_parts])
        bad = np.flatnonzero(found == BAD)
        lost = set(np.searchsorted(ends, bad, side="right").tolist())
        at = np.where(found == BAD, 0, found)
        counts = np.where(found == BAD, 0, self.count.held[at])
        places = spread(self.first.held[at], counts)
        sizes, links = self.sizes.held[places], self.links.held[places]
        total = lambda values: np.concatenate([[0], np.cumsum(values)])[ends]
        n_a, n_b, upto = np.diff(total(self.n_a.held[at]), prepend=0).tolist(), np.diff(total(self.n_b.held[at]), prepend=0).tolist(), total(counts).tolist()
        groups, found = self.groups, found.tolist()
        out, x, g = [], 0, 0
        for k, (y, h) in enumerate(zip(ends.tolist(), upto, strict=True)):
            out.append(None if k in lost else (n_a[k], n_b[k], b";".join([groups[i] for i in found[x:y]]).decode(), sizes[g:h], links[g:h]))
            x, g = y, h
        return out


@cache
def _aligner(byte_level: str, piece_model: str) -> Aligner:
    return Aligner(byte_level, piece_model)


def lists(values: list, kind) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate([*values, np.zeros(0, kind)]).astype(kind)))


def align(docs: DataFrame, byte_level: str, piece_model: str, key: str = "doc_id", text: str = "text", then=None, schema: str = "") -> DataFrame:
    """One row per row of ``docs``: (id, n_a, n_b, groups, sizes, links).

    ``groups`` lists the ids of both in each group, ``a1,a2|b1;a3|b2,b3``; ``sizes`` the bytes of each group of the text with a
    blank before it; ``links`` the pairs of A and B tokens that end together, as A's id times 2^32 plus B's. Texts that are null or
    empty, or whose decoded tokens are not their bytes, have no tokens. Rows with a null or repeated id are documents of
    their own. Only the two named columns are read, so no other name can clash; empty tables give no rows. A worker holds a
    few documents and its memory of parts; a text without blanks is one part.

    ``then`` is a function from batches of these rows to batches of ``schema``. It runs in the same worker, so that neither groups nor links,
    which are several times the texts, go through the JVM to another one.
    """
    names = ["id", "n_a", "n_b", "groups", "sizes", "links"]

    def run(batches):
        aligner = _aligner(byte_level, piece_model)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            first = 0
            while first < len(texts):
                # A bounded number of characters goes out together.
                last, size = first, 0
                while last < len(texts) and (last == first or size + len(texts[last]) <= 2 * WINDOW):
                    size += len(texts[last])
                    last += 1
                found = aligner.texts(texts[first:last])
                columns = [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.string()), lists([f[3] for f in found], np.int32), lists([f[4] for f in found], np.int64)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), *columns], names=names)
                first = last

    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if then is not None:
        return rows.mapInArrow(lambda batches: then(run(batches)), schema)
    return rows.mapInArrow(run, f"id {docs.schema[key].dataType.simpleString()}, n_a long, n_b long, groups string, sizes array<int>, links array<long>")


def block_schema(kinds: str) -> str:
    return f"block long, {kinds}, places array<int>, pairs array<long>, times array<long>"


def gathered(facts: list[str]):
    """A function that puts batches of the ``facts`` columns and ``links`` into blocks.

    A row's links are in one block: a block ends when it has BLOCK links. It has its rows, with the places of their links' pairs, and one row of its
    distinct pairs with their counts.
    """
    names = ["block", *facts, "places", "pairs", "times"]

    def gather(batches):
        block, held, count, empty = TaskContext.get().partitionId() << 32, [], 0, None

        def close():
            found = pa.array(np.concatenate(held)).dictionary_encode()
            pairs = found.dictionary.to_numpy()
            order = np.argsort(pairs)
            place = np.empty(len(pairs), np.int32)
            place[order] = np.arange(len(pairs), dtype=np.int32)
            at = place[found.indices.to_numpy()]
            sizes = np.cumsum([0, *map(len, held)])
            return pairs[order], np.bincount(at, minlength=len(pairs)), [np.sort(at[a:b]) for a, b in zip(sizes[:-1], sizes[1:], strict=True)]

        waiting: list = []

        def out():
            nonlocal block, held, waiting, count
            pairs, times, places = close()
            done = 0
            for rows in waiting:
                n = rows.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([block] * n, pa.int64()), *rows.columns, lists(places[done : done + n], np.int32), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))], names=names)
                done += n
            blank = [pa.nulls(1, t) for t in empty]
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *blank, pa.nulls(1, pa.list_(pa.int32())), lists([pairs], np.int64), lists([times], np.int64)], names=names)
            block, held, waiting, count = block + 1, [], [], 0

        for batch in batches:
            empty = [c.type for c in batch.columns[:-1]]
            column = batch.column(batch.num_columns - 1)
            found = [x.values.to_numpy(zero_copy_only=False) for x in column]
            first = 0
            for k, links in enumerate(found):
                held.append(links)
                count += len(links)
                if count >= BLOCK or k == len(found) - 1:
                    waiting.append(pa.RecordBatch.from_arrays([c.slice(first, k + 1 - first) for c in batch.columns[:-1]], names=facts))
                    first = k + 1
                    if count >= BLOCK:
                        yield from out()
        if held:
            yield from out()

    return gather


def link_counts(aligned: DataFrame, facts: list[str]) -> DataFrame:
    """The ``facts`` columns of every row with n_links, n_best and count_sum, from its ``links``.

    A link's count is how many links of the whole table have its pair; ``n_best`` counts the links whose count is the highest of their
    B id, ``count_sum`` adds the counts.
    """
    kinds = ", ".join(f"{c} {aligned.schema[c].dataType.simpleString()}" for c in facts)
    return block_counts(aligned.select(*facts, "links").mapInArrow(gathered(facts), block_schema(kinds)), facts)


def block_counts(blocks: DataFrame, facts: list[str]) -> DataFrame:
    """``link_counts`` of rows that are in blocks."""
    kinds = ", ".join(f"{c} {blocks.schema[c].dataType.simpleString()}" for c in facts)
    kept = stored(blocks, "alignment-blocks")
    held = kept.filter("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "p")).select("block", "place", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    totals = stored(held.groupBy("pair").agg(F.sum("times").alias("n")), "pair-counts")
    low = F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1))
    best = totals.groupBy(low.alias("b")).agg(F.max("n").alias("most"))  # one row per piece of B's vocabulary
    judged = totals.withColumn("b", low).join(best, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    back = held.select("block", "place", "pair").join(judged, "pair").select(F.col("block").alias("of"), "place", "n", "best")

    def add(key, rows, counts):
        _aligner.cache_clear()  # a worker that has aligned texts needs its memory no more
        n, best = np.zeros(counts.num_rows, np.int64), np.zeros(counts.num_rows, np.int64)
        place = counts["place"].to_numpy()
        n[place], best[place] = counts["n"].to_numpy(), counts["best"].to_numpy()
        column = rows["places"].combine_chunks()
        flat = column.flatten().to_numpy(zero_copy_only=False)
        sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        total = lambda v: np.diff(np.concatenate([[0], np.cumsum(v[flat])])[ends])
        return pa.table([*[rows[c] for c in facts], pa.array(sizes), pa.array(total(best)), pa.array(total(n))], names=[*facts, "n_links", "n_best", "count_sum"])

    rows = kept.filter("pairs IS NULL").select("block", *facts, "places")
    return rows.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(add, f"{kinds}, n_links long, n_best long, count_sum long")


FACTS = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]


@query("op11_token_alignment")
def op11_token_alignment(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gather = gathered(FACTS)

    def digests(batches):
        for batch in batches:
            id_, n_a, n_b, groups, sizes, links = batch.columns
            digest = [sha256(g).hexdigest() if n else "" for g, n in zip(groups.cast(pa.binary()).to_pylist(), n_a.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([id_, n_a, n_b, sizes.value_lengths().cast(pa.int64()), pa.array(digest, pa.string()), links], names=[*FACTS, "links"])

    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, groups_sha256 string"
    blocks = align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), then=lambda batches: gather(digests(batches)), schema=block_schema(kinds))
    return block_counts(blocks, FACTS).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
