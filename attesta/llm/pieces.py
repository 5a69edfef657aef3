"""SentencePiece encoding and decoding as a max-plus parallel scan.

A text's segmentation is the path of highest total score through the lattice of vocabulary pieces (the unigram reading of
a piece file). A unigram file's scores are its own. A merge file holds ranks, no probabilities: there the score of a piece is the
logarithm of 1 / (rank + OFFSET), as word frequencies fall with their rank. Long documents are cut into chunks. A boundary's state is how far a piece
reaches into the next chunk, so a chunk is a matrix: entry state by exit state, the best score in between. Matrices
combine by (max, +), which is associative: prefix products over blocks of chunks give the scores at every boundary. Each
chunk then names the entry state of every exit state, these maps combine from the back in the same way, and every
chunk is traced back on its own. The result equals the trace through the whole text, ties included: of equal paths
the one whose last differing piece is the longest.

Where no piece of the vocabulary spans two characters the lattice is a single point. Between two such points lies a
short run, mostly a word, whose path is remembered, so common text costs one lookup per word.

Decoding joins the pieces. Text is not normalised: a blank stands before the text and blanks become U+2581.
"""

from __future__ import annotations

import math
import re
import zlib
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import query, table
from attesta.session import stored

CHUNK = 32_768  # code points
BLOCK = 64  # chunks combined by one task
OFFSET = 100
KNOWN = 400_000  # runs a worker remembers, twice: new ones and those before
NONE = -math.inf
MARK = "▁"


def tree(scores: dict[str, float]) -> dict:
    """Pieces by their characters: a node leads from a character to the next node and the score of the piece that ends there, if one does."""
    root: dict = {}
    for piece, score in scores.items():
        node = root
        for ch in piece[:-1]:
            node = node.setdefault(ch, [{}, None])[0]
        node.setdefault(piece[-1], [{}, None])[1] = score
    leaf: dict = {}  # one for all: most nodes lead nowhere
    waiting = [root]
    while waiting:
        node = waiting.pop()
        for ch, (after, score) in node.items():
            node[ch] = (after or leaf, score)
            if after:
                waiting.append(after)
    return root


class Pieces:
    """A piece file: vocabulary, scores, byte pieces and the points no piece spans."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        self.by_text: dict[str, tuple[int, float]] = {}
        self.bytes_: dict[int, int] = {}
        self.text_of: list[str | int | None] = []
        low = math.inf
        merges = model.trainer_spec.model_type == 2
        for n, p in enumerate(model.pieces):
            if p.type == 1:
                score = -math.log(OFFSET - p.score) if merges else p.score
                self.by_text[p.piece] = (n, score)
                low = min(low, score)
                self.text_of.append(p.piece)
            elif p.type == 6:
                self.bytes_[int(p.piece[3:5], 16)] = n
                self.text_of.append(int(p.piece[3:5], 16))
            else:
                self.text_of.append(None)
        self.unknown_score, self.unknown = low - 10, model.trainer_spec.unk_id
        self.longest = max(map(len, self.by_text))
        self.tree = tree({p: score for p, (_, score) in self.by_text.items()})
        spans = {p[k : k + 2] for p in self.by_text for k in range(len(p) - 1)}
        self.spans = spans
        # Points that a search can find: before a mark, and around characters that no longer piece holds.
        marked_inside = any(a != MARK and b == MARK for a, b in spans)
        self.alone = "" if marked_inside else "\n\t\r"
        self.alone = "".join(ch for ch in self.alone if not any(ch in s for s in spans))
        held = re.escape(self.alone)
        # Letters before a stop that no piece joins to letters are a run too.
        stops = re.escape("".join(ch for ch in ".,;:!?" if not any(b == ch and a.isalpha() for a, b in spans)))
        word = f"{MARK}*[^\\W\\d_]++(?:(?=[{stops}])|[^{MARK}{held}]*)|" if stops else ""
        rest = f"[{held}]|{MARK}*[^{MARK}{held}]+|{MARK}+" if held else f"{MARK}*[^{MARK}]+|{MARK}+"
        self.runs = re.compile(r"(?s).+" if marked_inside else word + rest)
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def forward(self, s: str, entry: list[float], n: int) -> tuple[list[float], list[int]]:
        """Best score and last piece's start of every position reached from the entry states by pieces that start before ``n``."""
        size = min(len(s), n + self.longest - 1)
        best, back = [NONE] * (size + 1), [-1] * (size + 1)
        for k, v in enumerate(entry[: size + 1]):
            best[k] = v
        root, longest, unknown = self.tree, self.longest, self.unknown_score
        for i in range(min(n, size)):
            here = best[i]
            if here == NONE:
                continue
            node, e = root, i
            for ch in s[i : i + longest]:
                found = node.get(ch)
                if found is None:
                    break
                node, score = found
                e += 1
                if score is not None:
                    score += here
                    if score > best[e]:
                        best[e] = score
                        back[e] = i
                if not node:
                    break
            # Below every piece's score, so it counts only where no piece holds the character alone.
            if here + unknown > best[i + 1]:
                best[i + 1], back[i + 1] = here + unknown, i
        return best, back

    def trace(self, s: str, back: list[int], end: int) -> tuple[list[int], int]:
        """Ids of the path that ends at ``end``, and the entry state it comes from."""
        out: list[int] = []  # from the back
        by_text = self.by_text
        while (begin := back[end]) >= 0:
            piece = s[begin:end]
            found = by_text.get(piece)
            if found is not None:
                out.append(found[0])
            else:
                out += [self.bytes_.get(b, self.unknown) for b in reversed(piece.encode("utf-8", "surrogatepass"))] if self.bytes_ else [self.unknown]
            end = begin
        out.reverse()
        return out, end

    def run(self, s: str) -> tuple[int, ...]:
        """Ids of a run between two points that no piece spans, not remembered in ``known`` yet."""
        found = self.older.get(s)
        if found is None:
            found = tuple(self.trace(s, self.forward(s, [0.0], len(s))[1], len(s))[0])
        if len(s) <= 64:
            if len(self.known) >= KNOWN:
                self.known, self.older = {}, self.known
            self.known[s] = found
        return found

    def cuts(self, s: str, n: int) -> tuple[int, int] | None:
        """The first point at or after the longest overhang and the last point up to ``n`` that no piece spans."""
        spans = self.spans
        first = next((k for k in range(self.longest - 1, n) if s[k - 1 : k + 1] not in spans), None)
        if first is None:
            return None
        return first, next(k for k in range(n, first - 1, -1) if k == len(s) or s[k - 1 : k + 1] not in spans)

    def middle(self, s: str) -> list[int]:
        """Ids of a text between two points that no piece spans."""
        words = self.runs.findall(s)
        ids = list(map(self.known.get, words))
        if None in ids:
            run = self.run
            ids = [run(w) if f is None else f for w, f in zip(words, ids, strict=True)]
        return list(chain.from_iterable(ids))

    def score(self, s: str) -> float:
        """Best score of a text between two points that no piece spans."""
        return sum(self.forward(w, [0.0], len(w))[0][len(w)] for w in self.runs.findall(s))

    def encode(self, text: str) -> list[int]:
        """Ids of a whole short text."""
        return self.middle(normal(text)) if text else []

    def matrix(self, s: str, n: int) -> np.ndarray:
        """Entry by exit state: the best score of a chunk of ``n`` characters; ``s`` also holds what may overhang."""
        size = self.longest
        out = np.full((size, size), NONE)
        cut = self.cuts(s, n)
        if cut is None:
            for a in range(size):
                best, _ = self.forward(s, [NONE] * a + [0.0], n)
                out[a, : len(best) - n] = best[n : n + size]
            return out
        first, last = cut
        body = self.score(s[first:last])
        tail = np.full(size, NONE)
        best, _ = self.forward(s[last:], [0.0], n - last)
        tail[: len(best) - (n - last)] = best[n - last :]
        for a in range(size):
            head = self.forward(s[:first], [NONE] * a + [0.0], first)[0][first]
            out[a] = head + body + tail
        return out

    def origins(self, s: str, n: int, entry: list[float]) -> list[int]:
        """The entry state of the best path to each exit state, -1 where there is none."""
        size = self.longest
        cut = self.cuts(s, n)
        if cut is not None:
            first = cut[0]
            start = self.trace(s, self.forward(s[:first], entry, first)[1], first)[1]
            return [start] * size
        best, back = self.forward(s, entry, n)
        return [self.trace(s, back, n + k)[1] if n + k < len(best) and best[n + k] > NONE else -1 for k in range(size)]

    def chunk(self, s: str, n: int, entry: list[float], leave: int) -> tuple[list[int], int]:
        """Ids of the pieces that start in the chunk on the best path, and the entry state."""
        cut = self.cuts(s, n)
        if cut is None:
            return self.trace(s, self.forward(s, entry, n)[1], n + leave)
        first, last = cut
        head, begin = self.trace(s, self.forward(s[:first], entry, first)[1], first)
        tail, _ = self.trace(s[last:], self.forward(s[last:], [0.0], n - last)[1], n - last + leave)
        return head + self.middle(s[first:last]) + tail, begin

    def decode(self, ids) -> str:
        """The text of a whole document's ids; bytes that are no UTF-8 become U+FFFD, control ids nothing."""
        return self.joined(ids).replace(MARK, " ")[1:]

    def joined(self, ids) -> str:
        texts = list(map(self.text_of.__getitem__, ids))
        try:
            return "".join(texts)
        except TypeError:
            pass  # there are byte pieces or control ids
        out, raw = [], bytearray()
        for t in texts:
            if isinstance(t, int):
                raw.append(t)
            else:
                if raw:
                    out.append(raw.decode("utf-8", "replace"))
                    raw = bytearray()
                out.append(t or "")
        out.append(raw.decode("utf-8", "replace"))
        return "".join(out)


def normal(text: str) -> str:
    return MARK + text.replace(" ", MARK)


@cache
def vocabulary(path: str) -> Pieces:
    return Pieces(path)


def times(v: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Max-plus product of a row or a matrix with a matrix."""
    return np.max(v[..., :, None] + m, axis=-2)


def boundary_scores(matrices: DataFrame, size: int, chunks: int) -> DataFrame:
    """(doc, chunk, state) before every chunk, from (doc, chunk, m): prefix products over blocks of chunks.

    No task holds more than BLOCK matrices of one document; with more chunks, the blocks' products go through the same
    scan one level up.
    """

    def load(m) -> np.ndarray:
        return np.frombuffer(m, dtype=np.float64).reshape(size, size)

    def first() -> np.ndarray:
        v = np.full(size, NONE)
        v[0] = 0.0
        return v

    def product(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        whole = load(pdf["m"].iloc[0])
        for m in pdf["m"].iloc[1:]:
            whole = times(whole, load(m))
        return pd.DataFrame({"doc": [pdf["doc"].iloc[0]], "chunk": [pdf["chunk"].iloc[0] // BLOCK], "m": [whole.tobytes()]})

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        v = first() if pdf["before"].iloc[0] is None else np.frombuffer(pdf["before"].iloc[0], dtype=np.float64)
        states = []
        for m in pdf["m"]:
            states.append(v.tobytes())
            v = times(v, load(m))
        return pd.DataFrame({"doc": pdf["doc"], "chunk": pdf["chunk"], "state": states})

    rows = matrices.withColumn("block", F.floor(F.col("chunk") / BLOCK))
    if chunks <= BLOCK:
        rows = rows.withColumn("before", F.lit(None).cast("binary"))
    else:
        blocks = stored(rows.groupBy("doc", "block").applyInPandas(product, "doc long, chunk long, m binary"), "blocks")
        above = boundary_scores(blocks, size, -(-chunks // BLOCK))
        rows = rows.join(above.select("doc", F.col("chunk").alias("block"), F.col("state").alias("before")), ["doc", "block"])
    return rows.select("doc", "block", "chunk", "m", "before").groupBy("doc", "block").applyInPandas(walk, "doc long, chunk long, state binary")


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(id, n_chunks, exact, ids) of every row of ``docs``.

    ``exact`` tells that the ids decode to the text: every text's own ids are decoded and compared, a long one's chunk by chunk. Null and empty texts have no ids. Rows with a null or repeated id are
    documents of their own. Only the two named columns are read, so no other name can clash; empty tables give no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = f"id {kind}, n_chunks long, exact boolean, ids array<int>"
    names = ["id", "n_chunks", "exact", "ids"]

    def lists(found: list[list[int]]) -> pa.Array:
        ends = np.cumsum([0, *map(len, found)])
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(ends[-1]))
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))

    def short(batches):
        pieces = vocabulary(model)
        for batch in batches:
            ids, exact = [], []
            for t in batch.column(1).to_pylist():
                ids.append(pieces.encode(t))
                exact.append(pieces.decode(ids[-1]) == t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.ones(len(ids), np.int64)), pa.array(exact, pa.bool_()), lists(ids)], names=names)

    def split(batches):
        part, count, over = TaskContext.get().partitionId(), 0, vocabulary(model).longest - 1
        for batch in batches:
            for key_value, t in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                s = normal(t)
                n = max(1, len(s) // chunk)
                doc = (part << 40) + count
                count += 1
                for k in range(n):
                    # The last chunk takes what is left, so none is shorter than a piece's overhang.
                    end = (k + 1) * chunk if k < n - 1 else len(s)
                    piece = s[k * chunk : end + over]
                    yield pa.RecordBatch.from_arrays([pa.array([doc]), pa.array([key_value.as_py()], key_value.type), pa.array([n]), pa.array([k]), pa.array([end - k * chunk]), pa.array([piece])], names=["doc", "id", "n_chunks", "chunk", "size", "piece"])

    longs = rows.filter(F.length("text") >= 2 * chunk).mapInArrow(split, f"doc long, id {kind}, n_chunks long, chunk long, size long, piece string")
    from_short = rows.filter(F.length("text") < 2 * chunk).mapInArrow(short, schema)
    pieces_table = stored(longs.repartition("doc", "chunk"), "chunks")
    most = pieces_table.agg(F.max("n_chunks")).first()[0]
    if most is None:
        return from_short
    size = vocabulary(model).longest

    def matrices(batches):
        pieces = vocabulary(model)
        for pdf in batches:
            yield pd.DataFrame({"doc": pdf["doc"], "chunk": pdf["chunk"], "m": [pieces.matrix(s, n).tobytes() for s, n in zip(pdf["piece"], pdf["size"], strict=True)]})

    def origin_maps(batches):
        """The maps as matrices of the scan from the back: exit by entry state, 0 where the path leads."""
        pieces = vocabulary(model)
        for pdf in batches:
            out = []
            for s, n, state in zip(pdf["piece"], pdf["size"], pdf["state"], strict=True):
                m = np.full((size, size), NONE)
                for leave, enter in enumerate(pieces.origins(s, n, np.frombuffer(state, dtype=np.float64).tolist())):
                    if enter >= 0:
                        m[leave, enter] = 0.0
                out.append(m.tobytes())
            yield pd.DataFrame({"doc": pdf["doc"], "chunk": pdf["n_chunks"] - 1 - pdf["chunk"], "m": out})

    def traced(batches):
        pieces = vocabulary(model)
        for pdf in batches:
            ids, exact = [], []
            for s, n, state, after in zip(pdf["piece"], pdf["size"], pdf["state"], pdf["leave"], strict=True):
                leave = int(np.argmax(np.frombuffer(after, dtype=np.float64)))
                found, enter = pieces.chunk(s, n, np.frombuffer(state, dtype=np.float64).tolist(), leave)
                ids.append(found)
                exact.append(pieces.joined(found) == s[enter : n + leave])
            yield pd.DataFrame({"doc": pdf["doc"], "id": pdf["id"], "n_chunks": pdf["n_chunks"], "chunk": pdf["chunk"], "exact": exact, "ids": ids})

    made = stored(pieces_table.select("doc", "chunk", "size", "piece").mapInPandas(matrices, "doc long, chunk long, m binary"), "matrices")
    scores = stored(boundary_scores(made, size, most), "scores")
    known = pieces_table.join(scores, ["doc", "chunk"])
    maps = stored(known.select("doc", "n_chunks", "chunk", "size", "piece", "state").mapInPandas(origin_maps, "doc long, chunk long, m binary"), "maps")
    leaves = boundary_scores(maps, size, most).withColumnRenamed("state", "leave").withColumnRenamed("chunk", "from_end")
    full = known.withColumn("from_end", F.col("n_chunks") - 1 - F.col("chunk")).join(leaves, ["doc", "from_end"])
    parts = full.select("doc", "id", "n_chunks", "chunk", "size", "piece", "state", "leave").mapInPandas(traced, f"doc long, id {kind}, n_chunks long, chunk long, exact boolean, ids array<int>")
    # A document's ids are one row again, as its text was.
    whole = parts.groupBy("doc").agg(F.first("id").alias("id"), F.max("n_chunks").alias("n_chunks"), F.bool_and("exact").alias("exact"), F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
    from_long = whole.select("id", "n_chunks", "exact", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
    return from_short.unionByName(from_long)


def decode(encoded: DataFrame, model: str, key: str = "id", ids: str = "ids") -> DataFrame:
    """(id, text) of lists of ids. A null list is null text; ids outside the vocabulary are an error."""
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches):
        pieces = vocabulary(model)
        for batch in batches:
            texts = [None if x is None else pieces.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return encoded.select(F.col(key).alias("id"), F.col(ids).alias("ids")).mapInArrow(run, f"id {kind}, text string")


def digests(encoded: DataFrame) -> DataFrame:
    """(id, n_chunks, n_tokens, exact, ids_crc32) of encoded documents."""
    kind = encoded.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            column = batch.column(3)
            counts = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            raw = np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False).astype("<u4")).tobytes()
            ends = np.cumsum(counts) * 4
            crc = [zlib.crc32(raw[e - 4 * n : e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts), batch.column(2), pa.array(crc, pa.int64())], names=["id", "n_chunks", "n_tokens", "exact", "ids_crc32"])

    return encoded.select("id", "n_chunks", "exact", "ids").mapInArrow(run, f"id {kind}, n_chunks long, n_tokens long, exact boolean, ids_crc32 long")


@query("op8_piece_scan")
def op8_piece_scan(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(encode(docs, public_tokenizers.path("piece_bpe_32k.model"))).withColumnRenamed("id", "doc_id")
