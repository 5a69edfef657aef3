"""Personal data by a skip-chain conditional random field.

Fixed patterns give the base spans: e-mail addresses, IP addresses, card and phone numbers. The field adds mentions that the
patterns miss, such as a phone number repeated without its plus sign. Its nodes are the base spans and the other
candidates of a text: words with an at sign and loose groups of digits. Neighbouring candidates form a chain; mentions
with the same local part or the same last digits, however far apart, are joined by skip edges that share their
potentials. Loopy belief propagation with base spans as evidence labels the rest; a candidate becomes a span when its label
is probable and a skip edge supports it. That holds in texts without base spans too, where candidates support each other.
A candidate that repeats the number of a base span, a phone number also without its country code, is evidence too: it
has the base span's label however often it is repeated, as each repeat would else bring its own doubt and outvote the base span.

The weights are trained on the candidates of a bounded sample of documents, labelled by the base patterns; skip
weights come from the labels of joined mentions there.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import free_name, query, table
from attesta.session import stored

KINDS = ("email", "ip", "card", "phone")
NOTHING = len(KINDS)  # the label of no entity
SAMPLE_DOCS = 4000
SAMPLE_NODES = 20_000
ROUNDS = 12
SURE = 0.9
NEAR = 80  # characters between neighbours of the chain
TAIL = 7  # last digits that tell a number
COUNTRY = 3  # digits of a country code at most

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOOSE = re.compile(r"\(?[0-9][\x20()0-9-]*(?:\.(?!\x20)[\x20()0-9-]*)*(?<=[0-9])")  # a full stop and a blank end it
DIGIT = re.compile(r"[0-9]")
AT_WORD = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+")


def _emails(t: str):
    """Leftmost addresses, found from their at signs, so long words cost one pass."""
    done, at = 0, t.find("@")
    while at >= 0:
        left = at
        while left > done and t[left - 1] in LOCAL:
            left -= 1
        found = DOMAIN.match(t, at + 1) if left < at else None
        if found:
            yield left, found.end()
            done = found.end()
        at = t.find("@", found.end() if found else at + 1)


def _addresses(t: str, first: int):
    """Dotted chains of digits by groups of four parts; a group with a part above 255 is dropped."""
    for m in DOTTED.finditer(t, first):
        if m.end() - m.start() < 7:
            continue
        parts, at = m.group().split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            size = sum(map(len, parts[k : k + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[k : k + 4]):
                yield at, at + size
            at += size + 1


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind and start."""
    out = [(0, a, b) for a, b in _emails(t)]
    first = DIGIT.search(t)
    if first:
        first = first.start()
        out += [(1, a, b) for a, b in _addresses(t, first)]
        for m in CARD.finditer(t, first):
            if m.end() - m.start() >= 13:
                digits = re.sub(r"[^0-9]", "", m.group())
                if 13 <= len(digits) <= 19 and _luhn(digits):
                    out.append((2, m.start(), m.end()))
        for m in PHONE.finditer(t, max(0, first - 1)):
            if 9 <= len(DIGIT.findall(m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


@dataclass(frozen=True)
class Node:
    start: int
    end: int
    label: int | None  # of a base span; None where the field decides
    key: str
    whole: str


def _node(t: str, start: int, end: int, label: int | None) -> Node:
    text = t[start:end]
    if "@" in text:
        return Node(start, end, label, "@" + text.split("@")[0].lower(), text.lower())
    digits = re.sub(r"[^0-9]", "", text)
    return Node(start, end, label, digits[-TAIL:] if len(digits) >= TAIL else "", digits)


CUES = ("phone", "tel", "call", "mobile", "fax", "card", "visa", "credit", "ip", "server", "host", "mail", "contact")
LETTERS = re.compile(r"[A-Za-z]+\Z")
GOES_ON = re.compile(r"(?!(?:x|ext)\.?\x20?[0-9])[A-Za-z]", re.IGNORECASE)


def _in_word(t: str, start: int, end: int) -> bool:
    """Whether digits are part of a word, as of a hexadecimal key; a cue word before them and an extension after them are not."""
    before = LETTERS.search(t, max(0, start - 12), start)
    return bool(before and before.group().lower() not in CUES or GOES_ON.match(t, end))


def nodes(t: str, base: list[tuple[int, int, int]]) -> list[Node]:
    """Base spans and the candidates that overlap none, by place. Of overlapping base spans each is a node."""
    out = [_node(t, a, b, kind) for kind, a, b in base]
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    reach = np.maximum.accumulate([b for _, b in taken]).tolist() if taken else []

    def free(a: int, b: int) -> bool:
        k = int(np.searchsorted(starts, b))  # spans that start before b
        return k == 0 or reach[k - 1] <= a

    if "@" in t:
        at = t.find("@")
        # Whole words around at signs; a word is passed once.
        while at >= 0:
            left = at
            while left > 0 and t[left - 1] in LOCAL:
                left -= 1
            m = AT_WORD.match(t, left)
            if m and free(left, m.end()):
                out.append(_node(t, left, m.end(), None))
            at = t.find("@", max(at + 1, m.end() if m else 0))
    first = DIGIT.search(t)
    if first:
        for m in LOOSE.finditer(t, max(0, first.start() - 1)):
            if m.end() - m.start() >= TAIL and free(m.start(), m.end()) and not _in_word(t, m.start(), m.end()):
                n = _node(t, m.start(), m.end(), None)
                if TAIL <= len(n.whole) <= 19:
                    out.append(n)
    return sorted(out, key=lambda n: (n.start, n.end))


def edges(found: list[Node]) -> list[tuple[int, int, int]]:
    """(a, b, type): 0 chain, 1 equal, 2 similar. Each mention is joined to the one before it with its key, so repeats cost one edge each."""
    out = [(i, i + 1, 0) for i in range(len(found) - 1) if found[i + 1].start - found[i].end <= NEAR]
    last: dict[str, int] = {}
    for i, n in enumerate(found):
        if n.key:
            if n.key in last:
                out.append((last[n.key], i, 1 if found[last[n.key]].whole == n.whole else 2))
            last[n.key] = i
    return out


def tied(found: list[Node]) -> list[Node]:
    """The nodes, candidates that repeat a base span's number labelled as it is.

    The digits are the same, zeros before them aside; a phone number's also without a country code of up to three digits. Of base
    spans with one number that of the first kind counts.
    """
    sure: dict[str, int] = {}
    for n in found:
        if n.label is not None and n.whole.isdigit():
            for code in range(COUNTRY + 1 if KINDS[n.label] == "phone" else 1):
                number = n.whole[code:].lstrip("0")
                if len(number) >= TAIL:
                    sure[number] = min(n.label, sure.get(number, NOTHING))
    same = lambda n: sure.get(n.whole.lstrip("0")) if n.label is None else n.label
    return [replace(n, label=same(n)) for n in found]


def features(t: str, n: Node) -> list[int]:
    """Places of the active features of a node."""
    text = t[n.start : n.end]
    digits = len(n.whole) if "@" not in text else 0
    out = [0, 1 + min(digits, 20)]
    out += [22] if "@" in text else []
    out += [23] if text.count(".") == 3 else [24] if "." in text else []
    out += [25] if " " in text else []
    out += [26] if "-" in text else []
    out += [27] if "(" in text else []
    out += [28] if n.start and t[n.start - 1] == "+" or text[:1] == "+" else []
    out += [29] if 13 <= digits <= 19 and _luhn(n.whole) else []
    around = t[max(0, n.start - 30) : n.start].lower()
    out += [30 + k for k, cue in enumerate(CUES) if cue in around]
    return out


N_FEATURES = 30 + len(CUES)


@dataclass
class Weights:
    unary: np.ndarray  # features by labels
    chain: np.ndarray  # labels by labels
    skip: tuple[float, float]  # log odds of one label for equal and for similar mentions


def train(rows: list[tuple[list[int], int]], pairs: list[tuple[int, int, int]], steps: int = 1500, rate: float = 2.0, penalty: float = 1e-3) -> Weights:
    """Weights from (features, label) nodes and (label, label, edge type) pairs of the sample."""
    labels = NOTHING + 1
    x = np.zeros((len(rows), N_FEATURES))
    for k, (on, _) in enumerate(rows):
        x[k, on] = 1
    y = np.array([label for _, label in rows], dtype=int)
    w = np.zeros((N_FEATURES, labels))
    if len(rows):
        target = np.eye(labels)[y]
        for _ in range(steps):
            p = np.exp(x @ w - (x @ w).max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            w += rate * (x.T @ (target - p) / len(rows) - penalty * w)
    chain = np.full((labels, labels), 10.0)
    counts = np.ones((3, 2))
    for a, b, kind in pairs:
        counts[kind, int(a == b)] += 1
        if kind == 0:
            chain[a, b] += 1
    expected = chain.sum(1, keepdims=True) * chain.sum(0, keepdims=True) / chain.sum()
    odds = np.clip(np.log(counts[:, 1] / counts[:, 0]), 0, 6)
    # Equal mentions agree at least as much as similar ones.
    return Weights(w, np.clip(np.log(chain / expected), -2, 2), (float(max(odds[1], odds[2])), float(odds[2])))


def marginals(t: str, found: list[Node], joined: list[tuple[int, int, int]], weights: Weights) -> np.ndarray:
    """Label probabilities of every node by loopy belief propagation; base spans are evidence."""
    labels = NOTHING + 1
    unary = np.zeros((len(found), labels))
    for k, n in enumerate(found):
        if n.label is None:
            unary[k] = weights.unary[features(t, n)].sum(0)
        else:
            unary[k] = -50.0
            unary[k, n.label] = 0.0
    if joined:
        a, b, kind = (np.array(c) for c in zip(*joined, strict=True))
        same = np.eye(labels)
        forms = np.stack([weights.chain, weights.skip[0] * same, weights.skip[1] * same])
        pair = forms[kind]  # edge by label of a by label of b
        to_b, to_a = np.zeros((len(a), labels)), np.zeros((len(a), labels))
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, b, to_b)
            np.add.at(belief, a, to_a)
            new_b = _logsum((belief[a] - to_a)[:, :, None] + pair, 1)
            new_a = _logsum((belief[b] - to_b)[:, None, :] + pair, 2)
            new_b -= new_b.max(1, keepdims=True)
            new_a -= new_a.max(1, keepdims=True)
            change = max(np.abs(new_b - to_b).max(), np.abs(new_a - to_a).max())
            to_b, to_a = (new_b + to_b) / 2, (new_a + to_a) / 2  # damped, so loops settle
            if change < 1e-3:
                break
        np.add.at(unary, b, to_b)
        np.add.at(unary, a, to_a)
    p = np.exp(unary - unary.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def added_spans(t: str, base: list[tuple[int, int, int]], weights: Weights) -> list[tuple[int, int, int]]:
    """Spans that the field adds: probable labels of candidates that a skip edge joins to another mention."""
    found = nodes(t, base)
    joined = edges(found)
    backed = {i for a, b, kind in joined if kind for i in (a, b) if found[i].label is None}
    if not backed:
        return []
    found = tied(found)
    p = marginals(t, found, joined, weights)
    best = p.argmax(1)
    return [(int(best[i]), found[i].start, found[i].end) for i in sorted(backed) if best[i] != NOTHING and p[i, best[i]] >= SURE]


def _labelled(t: str):
    """Training nodes and pairs of one text, each phone number also without its plus sign, its country code and its separators."""
    base = base_spans(t)
    found = nodes(t, base)
    joined = edges(found)
    label = [NOTHING if n.label is None else n.label for n in found]
    rows = [(features(t, n), y) for n, y in zip(found, label, strict=True)]
    bare = [([f for f in on if f != 28], y) for on, y in rows if y == 3]
    bare += [([f - 2 if 10 <= f <= 21 else f for f in on], y) for on, y in bare]
    bare += [([f for f in on if not 23 <= f <= 27], y) for on, y in bare]
    pairs = [(label[a], label[b], kind) for a, b, kind in joined] + [(3, 3, 2)] * len(bare)
    return rows + bare, pairs


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS, sample_nodes: int = SAMPLE_NODES) -> Weights:
    """Train on at most ``sample_nodes`` nodes and as many pairs of about ``sample_docs`` documents, chosen by a hash of key and text."""
    total = docs.count()
    share = min(1.0, sample_docs / max(1, total))
    limit = int(share * (2**31 - 1))
    spot = F.xxhash64(F.col(key).cast("string"), F.col(text))

    def run(batches):
        for batch in batches:
            rows, pairs = [], []
            for t in batch.column(0).to_pylist():
                r, p = _labelled(t)
                rows.append([{"on": on, "label": y} for on, y in r])
                pairs.append([{"a": a, "b": b, "kind": k} for a, b, k in p])
            kinds = batch_types
            yield pa.RecordBatch.from_arrays([pa.array(rows, kinds[0]), pa.array(pairs, kinds[1])], names=["nodes", "pairs"])

    batch_types = (pa.list_(pa.struct([("on", pa.list_(pa.int32())), ("label", pa.int32())])), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("kind", pa.int32())])))
    picked = docs.filter(F.shiftright(spot, 33).bitwiseAND(2**31 - 1) <= limit).select(F.coalesce(F.col(text), F.lit("")).alias("t"))
    made = picked.mapInArrow(run, "nodes array<struct<on:array<int>,label:int>>, pairs array<struct<a:int,b:int,kind:int>>").filter("size(nodes) > 0")
    made = stored(made.withColumn("spot", F.xxhash64("nodes")), "pii-sample")

    def drawn(column: str) -> list:
        """Whole documents in the order of their hash, as far as the bound goes; it holds before anything reaches the driver."""
        each = made.select("spot", F.posexplode(column).alias("at", "x"))
        return [r["x"] for r in each.orderBy("spot", "at", "x").limit(sample_nodes).collect()]

    return train([(list(n["on"]), n["label"]) for n in drawn("nodes")], [(p["a"], p["b"], p["kind"]) for p in drawn("pairs")])


def find(docs: DataFrame, weights: Weights, each: Callable, schema: str, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``each(text, base, added)`` of every row as further columns after key and ``carry``."""
    names = [part.split()[0] for part in schema.split(", ")]
    fields = [docs.schema[c] for c in (key, *carry)]
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for t in batch.column(batch.num_columns - 1).to_pylist():
                base = base_spans(t)
                for column, value in zip(out, each(t, base, added_spans(t, base, weights)), strict=True):
                    column.append(value)
            kept = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(c, pa.int64() if s.split()[1] == "long" else pa.string()) for c, s in zip(out, schema.split(", "), strict=True)]], names=[f.name for f in fields] + names)

    hidden = "_text_of_row"
    picked = docs.select(*[F.col(f"`{c}`") for c in (key, *carry)], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(hidden))
    return picked.mapInArrow(run, f"{own}, {schema}")


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def digest(t: str, base: list, added: list) -> tuple:
    counts = [sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))]
    return (*counts, hashlib.sha256(spelled(base).encode()).hexdigest(), spelled([*base, *added]))


def masked(t: str, base: list, added: list) -> tuple:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    out, done = [], 0
    for kind, a, b in sorted([*base, *added], key=lambda s: (s[1], -s[2], s[0])):
        if a >= done:
            out += [t[done:a], f"[{KINDS[kind].upper()}]"]
        done = max(done, b)
    return ("".join([*out, t[done:]]),)


def redact(docs: DataFrame, weights: Weights | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with personal data masked in ``text``; null text stays null, other columns and their order stay.

    Each row stands for itself, so repeated rows and null keys need no rule; empty tables give no rows. The work column's
    name is chosen so that it clashes with none of the caller's.
    """
    fresh = free_name(docs, "masked")
    others = tuple(c for c in docs.columns if c not in (key, text))
    absent = free_name(docs, "absent")
    flagged = docs.withColumn(absent, F.col(f"`{text}`").isNull())
    done = find(flagged, weights or fit(docs, key, text), masked, f"{fresh} string", key, text, (*others, absent))
    return done.withColumn(text, F.when(~F.col(absent), F.col(fresh))).select(*[F.col(f"`{c}`") for c in docs.columns])


@query("op6_pii_skip_chain")
def op6_pii_skip_chain(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    schema = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return find(docs, fit(docs), digest, schema)
