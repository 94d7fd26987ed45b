"""Personal data: exact patterns, and more mentions by a skip-chain conditional random field.

Patterns give the base spans. The field then labels every candidate token (one that holds a
digit or an at sign; all others are fixed to "none", which cuts the chain into short runs
without changing the model). Neighbouring candidates share chain potentials; candidates that
repeat each other's digits or mailbox name, however far apart, share skip potentials. Loopy
sum-product messages run over many documents at once, so evidence at one mention makes the
others agree. Every document with a candidate is in the field, with base spans or without.
Tokens labelled with enough certainty that no base span touches are added as spans; base
spans always stay.

The weights are learned here, by pseudo-likelihood, from base spans of a sample of at most
``SAMPLE_DOCUMENTS`` documents that have any, chosen by a hash of their id. Of a document,
the sample holds the ``SAMPLE_TOKENS`` candidates nearest to base spans, each cut to
``SAMPLE_CHARACTERS`` characters; this bounds learning alone, finding reads whole texts. Weakened mentions
of the spans found (other separators, no plus sign, no domain ending) are added to the
sample, so that the field learns what repeated mentions look like.

Defined results: a null text is empty and has no spans. Every row is judged by itself, so
ties and repeated rows get equal results. With nothing to learn from, no spans are added. An
empty table gives an empty result; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from labelloom.deploy import ship_package
from labelloom.llm.shared import read_table

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCUMENTS = 1500
SAMPLE_TOKENS = 400  # candidates of a document in the sample, at most
SAMPLE_CHARACTERS = 200  # of a candidate in the sample, at most
LEAST_CERTAIN = 0.9
GRAPH_TOKENS = 20_000  # candidates of whole documents that are labelled at once, about
ROUNDS, DAMPING = 12, 0.3
STEPS, RATE, DECAY = 400, 0.5, 1e-4

# -- patterns -----------------------------------------------------------------------
# Look-behinds keep runs of digits from being tried at each of their digits; a match that
# fails at a run's start fails inside it as well.

MAILBOX = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
CALL = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
CANDIDATE = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """A match begins where the run of mailbox characters before an at sign does."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in MAILBOX:
            start -= 1
        if start < at and (host := HOST.match(text, at)):
            end = host.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) in order."""
    found = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in ADDRESS.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
                   for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in NUMBER.finditer(text):
            digits = digits_of(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in CALL.finditer(text):
                if 9 <= len(digits_of(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


# -- the field ----------------------------------------------------------------------

NONE = len(KINDS)
LABELS = NONE + 1


@dataclass
class Graph:
    """Candidates of many documents: token spans, features, chain and skip edges."""

    owner: list[int] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)
    base: list[int] = field(default_factory=list)
    rows: list[list[float]] = field(default_factory=list)
    chain: list[tuple[int, int]] = field(default_factory=list)
    skip: list[tuple[int, int]] = field(default_factory=list)

    def add(self, owner: int, text: str, spans: Sequence[tuple[int, int, int]]) -> None:
        last: dict[tuple[str, str], int] = {}
        at, before = 0, None
        for m in CANDIDATE.finditer(text):
            token, here = m[0], len(self.owner)
            while at < len(spans) and spans[at][2] <= m.start():
                at += 1
            kind = min((k for s, k, e in spans[at : at + 4] if s < m.end() and e > m.start()),
                       default=NONE)
            self.owner.append(owner)
            self.spans.append(m.span())
            self.base.append(kind)
            self.rows.append(features(token, kind))
            if before is not None and m.start() - before <= 1:
                self.chain.append((here - 1, here))
            before = m.end()
            if key := alike(token):
                if key in last:  # the mention before stands for all earlier ones
                    self.skip.append((last[key], here))
                last[key] = here


def alike(token: str) -> tuple[str, str] | None:
    """What similar mentions have in common: a mailbox name, or the last seven digits."""
    if "@" in token:
        return "@", token.partition("@")[0].strip("\"'<([{").lower()
    digits = digits_of(token)
    return ("#", digits[-7:]) if len(digits) >= 3 else None


def features(token: str, base: int) -> list[float]:
    digits = len(DIGIT.findall(token))
    row = [1.0, *(float(base == k) for k in range(NONE))]
    row += [float(c in token) for c in "@.-+()/:"]
    row += [float(digits == 0), float(digits in (1, 2)), float(3 <= digits <= 4),
            float(5 <= digits <= 8), float(9 <= digits <= 11), float(12 <= digits <= 19),
            float(digits > 19), float(token.count(".") == 3), float(token.count("-") == 3),
            float(any(c.isalpha() for c in token)), float(token.isdigit())]
    return row


@dataclass
class Weights:
    node: np.ndarray  # features x labels
    chain: np.ndarray  # left label x right label
    skip: np.ndarray  # agreement, by label


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _edges(pairs: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    both = np.array(pairs, dtype=np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def learn(graph: Graph, labels: list[int]) -> Weights:
    """Maximum pseudo-likelihood: each label given its neighbours' labels."""
    x, y = np.array(graph.rows), np.eye(LABELS)[labels]
    (cl, cr), (sl, sr) = _edges(graph.chain), _edges(graph.skip)
    beside = np.zeros_like(y)
    np.add.at(beside, sl, y[sr])
    np.add.at(beside, sr, y[sl])
    w = Weights(np.zeros((x.shape[1], LABELS)), np.zeros((LABELS, LABELS)), np.zeros(LABELS))
    for _ in range(STEPS):
        logits = x @ w.node + beside * w.skip
        np.add.at(logits, cr, y[cl] @ w.chain)
        np.add.at(logits, cl, y[cr] @ w.chain.T)
        off = (y - _softmax(logits)) / len(y)
        w.node += RATE * (x.T @ off - DECAY * w.node)
        w.skip += RATE * ((beside * off).sum(axis=0) - DECAY * w.skip)
        w.chain += RATE * (y[cl].T @ off[cr] + off[cl].T @ y[cr] - DECAY * w.chain)
    return w


def marginals(graph: Graph, w: Weights) -> np.ndarray:
    """Label probabilities by loopy sum-product messages over chain and skip edges."""
    node = np.array(graph.rows) @ w.node
    (cl, cr), (sl, sr) = _edges(graph.chain), _edges(graph.skip)
    source, target = np.r_[cl, cr, sl, sr], np.r_[cr, cl, sr, sl]
    if not len(source):
        return _softmax(node)
    agree = np.diag(w.skip)
    tables = np.concatenate([
        np.broadcast_to(t, (n, LABELS, LABELS))
        for t, n in ((w.chain, len(cl)), (w.chain.T, len(cl)), (agree, 2 * len(sl)))
    ])
    chain, skip = len(cl), len(sl)
    reverse = np.r_[
        np.arange(chain) + chain, np.arange(chain),
        2 * chain + skip + np.arange(skip), 2 * chain + np.arange(skip),
    ]
    messages = np.zeros((len(source), LABELS))
    for _ in range(ROUNDS):
        belief = node.copy()
        np.add.at(belief, target, messages)
        out = (belief[source] - messages[reverse])[:, :, None] + tables
        top = out.max(axis=1, keepdims=True)
        new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
        new -= new.max(axis=1, keepdims=True)
        messages = DAMPING * messages + (1 - DAMPING) * new
    belief = node.copy()
    np.add.at(belief, target, messages)
    return _softmax(belief)


def weakened(text: str, kind: int) -> str:
    """Another way to write an entity, which the patterns do not take."""
    if kind == 0:
        return text.split("@")[0] + "@" + text.split("@")[1].split(".")[0]
    if kind == 1:
        return text.replace(".", "-")
    if kind == 2:
        digits = digits_of(text)
        return "/".join(digits[i : i + 4] for i in range(0, len(digits) - 7, 4)) + digits[-7:]
    return re.sub(r"^\+[0-9]+[\x20-]?", "", text) or text


def train(texts: Sequence[str]) -> Weights | None:
    """Weights from texts with base spans and weakened mentions of them."""
    dice, graph, labels = random.Random(7), Graph(), []
    for number, text in enumerate(texts):
        spans = base_spans(text)
        known = list(spans)
        for start, kind, end in spans:
            if dice.random() < 0.5:
                text += " so "
                mention = weakened(text[start:end], kind)
                known.append((len(text), kind, len(text) + len(mention)))
                text += mention
            if dice.random() < 0.2:  # some digits of an entity alone say nothing
                text += " so " + digits_of(text[start:end])[:3]
        first = len(graph.owner)
        graph.add(number, text, spans)
        for s, e in graph.spans[first:]:
            labels.append(min((k for a, k, b in known if a < e and b > s), default=NONE))
    return learn(graph, labels) if labels else None


def _edges_of_token(text: str, start: int, end: int) -> tuple[int, int]:
    """The span without punctuation around it."""
    while start < end and not (text[start].isalnum() or text[start] in "+("):
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    return start, end


def added_spans(
    texts: Sequence[str], base: Sequence[list[tuple[int, int, int]]], w: Weights | None
) -> list[list[tuple[int, int, int]]]:
    """What the field finds beside the base spans, for every text."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if w is None:
        return found
    graph = Graph()
    for i, (text, spans) in enumerate(zip(texts, base, strict=True)):
        graph.add(i, text, spans)
        if len(graph.owner) >= GRAPH_TOKENS:  # no edge leaves a document
            _add_labelled(graph, texts, base, w, found)
            graph = Graph()
    if graph.owner:
        _add_labelled(graph, texts, base, w, found)
    return found


def _add_labelled(graph: Graph, texts, base, w: Weights, found) -> None:
    """Put what the field finds in the documents of ``graph`` into ``found``."""
    sure = marginals(graph, w)
    chained = {right for _, right in graph.chain}
    run = None  # (owner, kind, start, end)

    def close() -> None:
        if run:
            owner, kind, s, e = run
            s, e = _edges_of_token(texts[owner], s, e)
            if s < e and all(e <= a or s >= b for a, _, b in base[owner]):
                found[owner].append((s, kind, e))

    for i, (label, p) in enumerate(zip(sure.argmax(axis=1), sure.max(axis=1), strict=True)):
        new = label != NONE and p >= LEAST_CERTAIN and graph.base[i] == NONE
        if new and run and i in chained and run[:2] == (graph.owner[i], label):
            run = (*run[:3], graph.spans[i][1])
        else:
            close()
            run = (graph.owner[i], int(label), *graph.spans[i]) if new else None
    close()


# -- on Spark -----------------------------------------------------------------------


def learn_from(docs: DataFrame) -> Weights | None:
    @pandas_udf("string")
    def evidence(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        """Candidates with what stands between them cut to a word; null without a base span."""
        for texts in parts:
            yield pd.Series([_condensed(t) for t in texts], dtype=object)

    rows = (
        docs.where(F.col("text").rlike("[0-9@]"))
        .select("doc_id", evidence("text").alias("text"))
        .where(F.col("text").isNotNull())
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text")
        .limit(SAMPLE_DOCUMENTS)
        .collect()
    )
    return train([r.text for r in rows])


def _condensed(text: str) -> str | None:
    spans = base_spans(text)
    if not spans:
        return None
    parts, end = [], 0
    for m in _around(spans, list(CANDIDATE.finditer(text))):
        gap = text[end : m.start()]
        parts += [gap if len(gap) <= 1 else " so ", m[0][:SAMPLE_CHARACTERS]]
        end = m.end()
    return "".join(parts)


def _around(spans: list[tuple[int, int, int]], tokens: list[re.Match]) -> list[re.Match]:
    """The ``SAMPLE_TOKENS`` candidates nearest to those that base spans touch, in order."""
    if len(tokens) <= SAMPLE_TOKENS:
        return tokens
    starts = np.array([m.start() for m in tokens])
    ends = np.array([m.end() for m in tokens])
    touched = np.zeros(len(tokens), bool)
    for start, _, end in spans:
        touched[np.searchsorted(ends, start, "right") : np.searchsorted(starts, end)] = True
    places, base = np.arange(len(tokens)), np.flatnonzero(touched)
    after = np.searchsorted(base, places)
    far = np.minimum(np.abs(places - base[np.maximum(after - 1, 0)]),
                     np.abs(places - base[np.minimum(after, len(base) - 1)]))
    return [tokens[i] for i in np.sort(np.argsort(far, kind="stable")[:SAMPLE_TOKENS])]


def _named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


COLUMNS = [*(f"n_{k}" for k in KINDS), "n_added", "base_sha256", "spans"]


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per document the base spans' numbers by kind, their digest, and all spans."""
    spark = ship_package(docs.sparkSession)
    weights = spark.sparkContext.broadcast(learn_from(docs))
    schema = ", ".join(f"{c} {'long' if c[:2] == 'n_' else 'string'}" for c in COLUMNS)

    @pandas_udf(schema)
    def find(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts = [t or "" for t in part]
            base = [base_spans(t) for t in texts]
            more = added_spans(texts, base, weights.value)
            rows = []
            for own, new in zip(base, more, strict=True):
                counts = [sum(k == n for _, k, _ in own) for n in range(NONE)]
                digest = sha256(_named(own).encode()).hexdigest()
                rows.append([*counts, len(new), digest, _named(own + new)])
            yield pd.DataFrame(rows, columns=COLUMNS)

    return docs.select("doc_id", find("text").alias("p")).select("doc_id", "p.*")


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(read_table(spark, sf_dir, "documents"))
