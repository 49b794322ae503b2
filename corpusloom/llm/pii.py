"""Personal data by a skip-chain conditional random field over a document's candidate tokens.

Base spans come from four fixed patterns and always stay; their labels are observed, so they are fixed during inference
and tell the tokens linked to them. The field labels the other candidate tokens (non-blank runs with a digit or an at
sign) as email, ip, card, phone or none; all other tokens are none by definition, so they only act as context features,
and inference over the candidates alone is the same as over the whole document. Potentials: token and context features;
chain edges between candidates that stand next to each other; skip edges between tokens that are the same or similar
(equal last digits, of a token or of a whole base span; equal mail name or domain) anywhere in the document. Two such
tokens are linked directly, more of them through one hub variable, so any two are two hops apart and the edges stay
linear in the tokens.

Weights are learned by pseudo-likelihood on a bounded, documented sample (`max_train_rows` texts with a digit or at
sign, of `max_train_bytes` together) whose labels are the base spans (a hub's label is the most common one of the other
tokens). As the patterns label no broken mention, some are made: to a share of the sample's texts a base span is added
once more in a form that no pattern takes (see broken()), with its kind as label; and numbers that no base span is like,
labelled none. Features are dropped at random while training, so that context and repetition carry weight.
Loopy belief propagation runs over all documents of a batch as one graph of separate parts, each until its messages
settle; one that swings without end keeps the messages of round `rounds`. A token whose marginal for a kind reaches
`add_at` and that touches no base span adds a span.

What a worker holds follows the candidates, at some 0.3 KB each, not the candidates times the features: tokens and edges
are flat arrays, keys are compared by 128-bit digests, and features, messages and training steps are worked on in blocks.
Documents are gathered up to GATHERED candidates; one of more makes a graph of its own.

Defined cases: null texts are empty; a text without candidates has no spans; very long texts are taken whole; spans that
start together are in the order of their kinds, and equal marginals go to the kind listed first; rows that repeat an id
are reported each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from . import textvec as tv

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)  # label of tokens that are none

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EVIDENCE = re.compile(r"[0-9@]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# possessive where nothing follows: the same matches, but no way back is kept for each repeat (100 bytes a character)
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_EDGES = re.compile(r"^[^A-Za-z0-9@+]+|[^A-Za-z0-9]+$")

TAIL = 7  # last digits that make numbers similar
HASHED = 64  # buckets of the words before and after
SHAPES = 26
OBSERVED = 60.0  # log odds of an observed label
FEATURES = SHAPES + 2 * HASHED + 1
BLOCK = 1 << 13  # tokens, links or edges that are worked on at once
GATHERED = 1 << 16  # candidates from which on documents are no longer gathered into one graph


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and non-overlapping within each kind, sorted."""
    found = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def shape(token: str) -> list[int]:
    """Indices of a token's own features."""
    digits, n = _digits(token), 0
    n = len(digits)
    core = _EDGES.sub("", token)
    parts = core.split(".")
    ipish = len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 6 for p in parts)
    at = token.find("@")
    flags = (
        n == 0, 1 <= n <= 3, 4 <= n <= 8, 9 <= n <= 11, 12 <= n <= 15, 16 <= n <= 19, n > 19,
        at > 0, at > 0 and "." in token[at + 2 :], at == 0, token.count("@") > 1,
        ipish, ipish and all(int(p) <= 255 for p in parts), len(parts) == 4, "+" in token, core.startswith("+"),
        12 <= n <= 19 and luhn(digits), 12 <= n <= 19 and luhn(digits) and len(core) == n, "-" in core, "(" in token, ":" in core or "=" in core,
        any(c.isalpha() for c in core), sum(c.isalpha() for c in core) > n, len(core) > 24, n == len(core), n > 0 and len(core) - n <= 3,
    )
    return [i for i, f in enumerate(flags) if f]


def keys_of(token: str, span: str = "") -> set[tuple[int, str]]:
    """What makes tokens the same (0) or similar (1); `span` is the base span that a token is part of."""
    core = _EDGES.sub("", token).lower()
    out = {(0, core)} if len(core) > 3 else set()
    for digits in (_digits(core), _digits(span)):
        if len(digits) >= TAIL:
            out.add((1, digits[-TAIL:]))
    if "@" in core[1:]:
        out |= {(1, core[: core.index("@") + 1]), (1, core[core.rindex("@") :])}
    return out


def broken(span: str, kind: int, rng: np.random.Generator) -> str:
    """A mention of a base span as texts break them: without its sign, with other separators, cut short."""
    digits = _digits(span)
    if kind == 0:
        name, _, domain = span.partition("@")
        return (f"{name}@{domain.split('.')[0]}", f"{name}@@{domain}", f"{name}@")[rng.integers(3)]
    if kind == 1:
        return (span.replace(".", "-"), ".".join(span.split(".")[:3]), span.replace(".", ".."))[rng.integers(3)]
    if kind == 2:
        return (digits[-8:], f"{digits[:4]}.{digits[4:8]}.{digits[8:]}", f"x{digits[4:]}")[rng.integers(3)]
    return (digits[-10:], f"{digits[-10:-7]}-{digits[-7:-4]}-{digits[-4:]}", digits, f"{digits[-7:-4]}.{digits[-4:]}")[rng.integers(4)]


def _blocks(n: int) -> Iterator[slice]:
    return (slice(a, min(a + BLOCK, n)) for a in range(0, n, BLOCK))


class Graph:
    """Candidate tokens of many documents: features, edges and places, in flat arrays."""

    def __init__(self) -> None:
        self.doc = array("i")
        self.start = array("i")
        self.end = array("i")
        self.label = array("b")
        self.flat = array("h")  # features, one token's after another's
        self.upto = array("q", [0])  # where a token's features begin; the next token's begin where they end
        self.hubs = 0
        self._edges = array("i")
        self._links = array("i")

    @property
    def feats(self) -> list[list[int]]:
        return [list(self.flat[a:b]) for a, b in zip(self.upto, self.upto[1:])]

    @property
    def edges(self) -> np.ndarray:
        """node, node, 0 chain / 1 same / 2 similar."""
        return np.array(self._edges, np.int32).reshape(-1, 3)

    @property
    def links(self) -> np.ndarray:
        """node, hub, 1 same / 2 similar."""
        return np.array(self._links, np.int32).reshape(-1, 3)

    def add(self, doc: int, text: str, base: list[tuple[int, int, int]]) -> None:
        digests, kinds, holders = bytearray(), array("b"), array("i")
        reach = list(accumulate((e for _, _, e in base), max))
        words = _WORD.finditer(text)
        last, m, beside = "", next(words, None), False
        while m:
            token, after = m[0], next(words, None)
            if candidate := bool(_EVIDENCE.search(token)):
                node = len(self.doc)
                first = bisect_right(reach, m.start())
                label, whole = OTHER, ""
                while first < len(base) and base[first][0] < m.end():
                    if base[first][2] > m.start():
                        label, whole = base[first][1], text[base[first][0] : base[first][2]]
                        break
                    first += 1
                around = [last, after[0] if after else ""]
                context = [SHAPES + j * HASHED + int.from_bytes(hashlib.blake2b(w.lower().encode(), digest_size=2).digest()) % HASHED for j, w in enumerate(around) if not _EVIDENCE.search(w)]
                self.doc.append(doc)
                self.start.append(m.start())
                self.end.append(m.end())
                self.label.append(label)
                self.flat.extend(shape(token) + context)
                self.upto.append(len(self.flat))
                if beside:
                    self._edges.extend((node - 1, node, 0))
                for kind, key in keys_of(token, whole):
                    digests += hashlib.blake2b(f"{kind}{key}".encode(), digest_size=16).digest()
                    kinds.append(kind)
                    holders.append(node)
            last, m, beside = token, after, candidate
        if len(holders) > 1:
            self._link(text, np.frombuffer(digests, np.uint64).reshape(-1, 2), kinds, holders)

    def _link(self, text: str, digests: np.ndarray, kinds: array, holders: array) -> None:
        """An edge between two holders of a key, a hub for more; keys in the order in which they first came."""
        order = np.lexsort(digests.T)  # stable
        sets = digests[order]
        starts = np.flatnonzero(np.append(True, (sets[1:] != sets[:-1]).any(axis=1)))
        size = np.diff(starts, append=len(order))
        many = np.flatnonzero(size > 1)
        for i in many[np.argsort(order[starts[many]])].tolist():
            held = order[starts[i] : starts[i] + size[i]].tolist()
            kind, nodes = kinds[held[0]], [holders[h] for h in held]
            if kind:
                tokens = (text[self.start[n] : self.end[n]].lower() for n in nodes)
                one = next(tokens)
                if all(t == one for t in tokens):
                    continue  # the same token again: linked as that
            if len(nodes) == 2:
                self._edges.extend((*nodes, 1 + kind))
            else:
                for node in nodes:
                    self._links.extend((node, self.hubs, 1 + kind))
                self.hubs += 1

    def matrix(self, part: slice | None = None) -> np.ndarray:
        """Features of all tokens or of a range; the last one is 1 everywhere."""
        part = part or slice(0, len(self.doc))
        upto = np.array(self.upto[part.start : part.stop + 1])
        x = np.zeros((part.stop - part.start, FEATURES), np.float32)
        x[np.repeat(np.arange(len(x)), np.diff(upto)), self.flat[upto[0] : upto[-1]]] = 1
        x[:, -1] = 1
        return x


@dataclass
class PiiModel:
    unary: np.ndarray  # features x labels
    pair: np.ndarray  # edge kinds x labels x labels, symmetric


@dataclass
class PiiConfig:
    max_train_rows: int = 3000
    max_train_bytes: int = 32 << 20
    epochs: int = 400
    rate: float = 0.5
    drop: float = 0.5
    l2: float = 1e-4
    made: float = 0.5  # share of the sample's texts with broken mentions
    add_at: float = 0.7
    rounds: int = 1000


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def with_broken(text: str, base: list[tuple[int, int, int]], rng: np.random.Generator, share: float) -> tuple[str, list[tuple[int, int, int]]]:
    """(text, labelled spans): to a share of the texts, broken mentions and unrelated numbers are added."""
    if rng.random() >= share:
        return text, base
    out, spans = text, list(base)
    for s, kind, e in base[:8]:
        mention = broken(text[s:e], kind, rng)
        number = str(rng.integers(10 ** (TAIL - 1), 10 ** rng.integers(TAIL, 13)))
        if not base_spans(mention) and not base_spans(number):
            pieces = [(mention, kind)] * (1 + (rng.random() < 0.2)) + [(number, OTHER)] * (1 + (rng.random() < 0.5))
            for piece, label in (pieces[i] for i in rng.permutation(len(pieces))):
                out += " and "  # apart, so that neither continues the other
                spans.append((len(out), label, len(out) + len(piece)))
                out += piece
    return out, sorted(spans)


def _around(graph: Graph, y: np.ndarray, labels: int) -> tuple[np.ndarray, np.ndarray]:
    """How often a token's neighbours have each label, by kind of edge (a hub's label is the most common of the others);
    and the tokens without a label that are like a base span: one may well be its mention, so it is neither taught nor
    teaches."""
    edges, links = graph.edges, graph.links
    known = np.zeros((graph.hubs, labels), np.int32)
    like = np.zeros(len(y), bool)
    for part in _blocks(len(links)):
        node, hub, _ = links[part].T
        np.add.at(known, (hub, y[node]), 1)
    for part in _blocks(len(edges)):
        a, b, kind = edges[part].T
        for one, two in ((a, b), (b, a)):
            like[one[(kind > 0) & (y[two] != OTHER)]] = True
    spanned = known[:, :OTHER].sum(axis=1) > 0
    for part in _blocks(len(links)):
        node, hub, _ = links[part].T
        like[node[spanned[hub]]] = True
    unsure = like & (y == OTHER)
    known[:, OTHER] = 0
    for part in _blocks(len(links)):
        node, hub, _ = links[part].T
        np.add.at(known[:, OTHER], hub[(y[node] == OTHER) & ~unsure[node]], 1)
    near = np.zeros((len(y), 3 * labels), np.uint8)  # a token has at most two neighbours and a handful of keys
    for part in _blocks(len(edges)):
        a, b, kind = edges[part][~unsure[edges[part, :2]].any(axis=1)].T
        for one, two in ((a, b), (b, a)):
            np.add.at(near, (one, kind * labels + y[two]), 1)
    for part in _blocks(len(links)):
        node, hub, kind = links[part].T
        others = known[hub] - np.eye(labels, dtype=np.int32)[y[node]] * ~unsure[node][:, None]
        sure = ~unsure[node] & (others.sum(axis=1) > 0)
        np.add.at(near, (node[sure], (kind * labels + others.argmax(axis=1))[sure]), 1)
    return near, unsure


def train(texts: list[str], config: PiiConfig) -> PiiModel:
    """Pseudo-likelihood: each label given its neighbours', full-batch AdaGrad whose sums go over blocks of tokens."""
    graph, making = Graph(), np.random.default_rng(7)
    for i, t in enumerate(texts):
        graph.add(i, *with_broken(t, base_spans(t), making, config.made))
    labels = OTHER + 1
    model = PiiModel(np.zeros((FEATURES, labels)), np.zeros((3, labels, labels)))
    if not graph.doc:
        model.unary[-1, OTHER] = 5.0
        return model
    y = np.array(graph.label)
    near, unsure = _around(graph, y, labels)
    rng = np.random.default_rng(5)
    gu, gp = np.full(model.unary.shape, 1e-6), np.full(model.pair.shape, 1e-6)
    weight = np.where(unsure, 0.0, np.where(y == OTHER, 1.0, 3.0))[:, None] / len(y)
    for _ in range(config.epochs):
        both, total = np.concatenate([model.unary, model.pair.reshape(-1, labels)]), 0.0
        for part in _blocks(len(y)):
            seen = graph.matrix(part)
            seen *= rng.random(seen.shape) >= config.drop
            seen[:, -1] = 1
            seen = np.concatenate([seen, near[part]], axis=1, dtype=np.float64)
            wrong = (_softmax(seen @ both) - np.eye(labels)[y[part]]) * weight[part]
            total += seen.T @ wrong
        du = total[:FEATURES] + config.l2 * model.unary
        gu += du * du
        model.unary -= config.rate * du / np.sqrt(gu)
        dp = total[FEATURES:].reshape(model.pair.shape)
        dp = (dp + dp.transpose(0, 2, 1)) / 2 + config.l2 * model.pair
        gp += dp * dp
        model.pair -= config.rate * dp / np.sqrt(gp)
    return model


def marginals(graph: Graph, model: PiiModel, rounds: int, settled: float = 1e-4) -> np.ndarray:
    """Loopy belief propagation, damped, all edges of the documents at once whose messages still move."""
    n = len(graph.doc)
    local = np.zeros((n + graph.hubs, model.unary.shape[1]))
    for part in _blocks(n):
        local[part] = graph.matrix(part) @ model.unary
    label = np.array(graph.label)
    known = np.flatnonzero(label != OTHER)  # parts of base spans are observed
    local[known] = -OBSERVED
    local[known, label[known]] = 0.0
    edges = np.concatenate([graph.edges, graph.links + np.array([0, n, 0], np.int32)])
    owner = np.array(graph.doc)[edges[:, 0]]
    message = np.zeros((2, len(edges), local.shape[1]))  # to the second node, to the first
    moving = np.arange(len(edges))
    belief = np.empty_like(local)
    for _ in range(rounds):
        if not len(moving):
            break
        belief[:] = local
        for side in (0, 1):
            for part in _blocks(len(moving)):
                np.add.at(belief, edges[moving[part], 1 - side], message[side, moving[part]])
        most = np.zeros(owner.max() + 1)
        for part in _blocks(len(moving)):
            now = moving[part]
            a, b, kind = edges[now].T
            old, pair = message[:, now], model.pair[kind]
            full = np.stack([belief[a] - old[1], belief[b] - old[0]])[..., None] + pair
            top = full.max(axis=2, keepdims=True)
            new = np.log(np.exp(full - top).sum(axis=2)) + top[:, :, 0]
            new -= new.mean(axis=2, keepdims=True)
            message[:, now] = 0.5 * old + 0.5 * new
            np.maximum.at(most, owner[now], np.abs(new - old).max(axis=(0, 2)))
        moving = moving[most[owner[moving]] > settled]
    belief = local
    for side in (0, 1):
        for part in _blocks(len(edges)):
            np.add.at(belief, edges[part, 1 - side], message[side, part])
    for part in _blocks(n):
        belief[part] = _softmax(belief[part])
    return belief[:n]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_in(texts: list[str | None], model: PiiModel, config: PiiConfig) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    out, graph = [], Graph()
    for i, text in enumerate(texts):
        base = base_spans(text) if text else []
        out.append((base, list(base)))
        if text:
            graph.add(i, text, base)
        if len(graph.doc) >= GATHERED:
            _add_spans(texts, graph, model, config, out)
            graph = Graph()
    _add_spans(texts, graph, model, config, out)
    return out


def _add_spans(texts: list[str | None], graph: Graph, model: PiiModel, config: PiiConfig, out: list[tuple[list, list]]) -> None:
    if not graph.doc:
        return
    p = marginals(graph, model, config.rounds)
    best = p[:, :OTHER].argmax(axis=1)
    added = np.flatnonzero((p[np.arange(len(p)), best] >= config.add_at) & (np.array(graph.label) == OTHER)).tolist()
    for node in added:
        doc, s, e = graph.doc[node], graph.start[node], graph.end[node]
        core = _EDGES.sub("", texts[doc][s:e])
        s += texts[doc][s:e].find(core) if core else 0
        out[doc][1].append((s, int(best[node]), s + (len(core) or e - s)))
    for doc in {graph.doc[node] for node in added}:
        out[doc][1].sort()


def fit(documents: DataFrame, config: PiiConfig | None = None) -> PiiModel:
    config = config or PiiConfig()
    known = documents.where(F.col("doc_id").isNotNull() & F.col("text").rlike("[0-9@]"))
    ids = common.drawn(known.select("doc_id").distinct(), config.max_train_rows)
    rows = common.sampled(known, ids, config.max_train_bytes)
    return common.trained(rows.select("text"), lambda t: train(t.column("text").to_pylist(), config))


def find_personal_data(documents: DataFrame, model: PiiModel, config: PiiConfig | None = None) -> DataFrame:
    """doc_id, counts of base spans, digest of the base spans, all spans."""
    config = config or PiiConfig()
    shared = documents.sparkSession.sparkContext.broadcast(model)
    evidence = np.zeros(256, bool)
    evidence[[*range(48, 58), 64]] = True
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tv.chunks(batch, "text"):
                some = [i for i in range(b - a) if evidence[data[offsets[i] : offsets[i + 1]]].any()]
                counts = np.zeros((len(KINDS), b - a), np.int64)
                digest, spans = [empty] * (b - a), [""] * (b - a)
                texts = [data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in some]
                for i, (base, every) in zip(some, find_in(texts, shared.value, config), strict=True):
                    for _, k, _ in base:
                        counts[k, i] += 1
                    digest[i], spans[i] = hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)
                yield pa.record_batch([batch.column(0).slice(a, b - a), *map(pa.array, counts), pa.array(digest), pa.array(spans)], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def op2_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(spark, sf_dir, "documents")
    return find_personal_data(documents, fit(documents))
