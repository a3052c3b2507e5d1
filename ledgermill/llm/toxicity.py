"""Toxicity of texts, read through a noisy channel.

Writers hide words: digits and signs for letters, blanks or marks between them, letters repeated. Each
suspicious token becomes a lattice of the letters it may stand for, and a Viterbi search picks the
reading that a character language model finds likeliest, given what each disguise costs. The model
counts the trigrams of all documents. The restored words are then scored: words and beginnings of words
that toxic documents of the training rows have and clean ones lack carry weight, and the weight of a
document is calibrated to a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.llm.texts import text_of
from ledgermill.session import stored

# The classifier is fitted on at most about so many labelled rows, chosen by hash; the language model on all rows.
TRAINING_ROWS = 20_000
THRESHOLD = 0.7
# A part carries weight if so many toxic training rows have it, and if it is so many times as frequent there as in clean
# ones, even with both counts one standard error less telling.
LEAST_ROWS, LEAST_RATIO = 5, 60.0
SHORTEST_PART, LONGEST_PART = 3, 6
# Tokens whose weight, and tokens whose readings, a task remembers.
REMEMBERED, REMEMBERED_READINGS = 100_000, 20_000
# Parts that a task counts before it hands its counts on.
COUNTED_PARTS = 50_000
# A document's summed weight grows no further than that of so many plain hits.
MOST_HITS = 50

# What digits and signs stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
# Costs of disguises, in nats: a sign for a letter, a mark between letters, a repeated letter, a blank dropped or kept.
SIGN_COST, MARK_COST, REPEAT_COST, DROP_COST, KEEP_COST = 1.0, 0.5, 1.0, 0.3, 1.5

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if chr(c).isalpha())
_CODE = {c: n for n, c in enumerate(LETTERS, 1)}
_OTHER = len(LETTERS) + 1
_N = _OTHER + 1  # 0 is the edge of a word
_EDGES = "\"'`.,;:?!()[]{}<>«»„“”‘’…-–—_*#%&|$+=/\\~^"
_SIGNS = frozenset(STANDS_FOR)
_PLAIN = re.compile(r"[^\W\d_]+")
# Marks at the end of a token that stand for nothing.
_ENDINGS = [mark + white for mark in ".,;:?" for white in " \n"]
_TWICE, _REPEATED = re.compile(r"(.)\1"), re.compile(r"(.)\1+")


def _code_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x3000):
        if chr(c).isalpha():
            table[c] = _CODE.get(chr(c), _OTHER)
    table[0x3000:] = _OTHER
    return table


def _trigrams(texts: list[str], table: np.ndarray) -> np.ndarray:
    """Numbers of all three codes in a row, one edge between words."""
    codes = table[np.frombuffer(f" {' '.join(texts).lower()} ".encode("utf-32-le"), np.uint32)].astype(np.int64)
    codes = codes[np.append(True, (codes[1:] != 0) | (codes[:-1] != 0))]
    return (codes[:-2] * _N + codes[1:-1]) * _N + codes[2:]


def _language_model(docs: DataFrame) -> np.ndarray:
    """Costs of a code after two others, from all texts. At most as many counts as there are trigrams."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, counts = _code_table(), np.zeros(_N**3, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 32):  # some texts at a time, whole ones
                texts = batch.column("text").slice(at, 32).to_pylist()
                counts += np.bincount(_trigrams(texts, table), minlength=_N**3)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["trigram", "n"])

    rows = docs.select(text_of().alias("text")).mapInArrow(count, "trigram bigint, n bigint")
    found = rows.groupBy("trigram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(_N**3)
    for row in found:
        counts[row.trigram] = row.n
    return costs_of(counts)


def costs_of(counts: np.ndarray) -> np.ndarray:
    """Negative logarithms of trigram probabilities, mixed with those of bigrams and single codes."""
    three = counts.reshape(_N, _N, _N)
    two, one = three.sum(0), three.sum((0, 1))
    single = (one + 1) / (one.sum() + _N)
    double = (two + 5 * single) / (two.sum(1, keepdims=True) + 5)
    return -np.log((three + 2 * double) / (three.sum(2, keepdims=True) + 2))


class Tree:
    """Parts of words, letter by letter, to tell at once that no path of a lattice can spell one of them.

    A leaf of a whole word is written ``$``; a beginning ends in an empty key.
    """

    def __init__(self, parts: Iterable[str]) -> None:
        self._root: dict = {}
        for part in parts:
            node = self._root
            for c in part.removesuffix("$"):
                node = node.setdefault(c, {})
            node["$" if part.endswith("$") else ""] = {}
        self.empty = not self._root

    def walk(self, lattice: Iterable[list[tuple[str, float]]]) -> tuple[bool, list[dict]]:
        """Whether a path begins with a known beginning, and the places in the tree where paths end that may go on.

        The lattice is only asked for as long as some path goes on.
        """
        places = [self._root]
        for options in lattice:
            following: dict[int, dict] = {}
            for place in places:
                for written, _ in options:
                    node: dict | None = place
                    for c in written:
                        node = node.get(c)
                        if node is None:
                            break
                        if "" in node:
                            return True, []
                    if node is not None:
                        following[id(node)] = node
            if not following:
                return False, []
            places = list(following.values())
        return False, places

    def holds(self, lattice: Iterable[list[tuple[str, float]]]) -> bool:
        """Whether some path spells a known part; only then is it worth finding the likeliest one."""
        begins, places = self.walk(lattice)
        return begins or any("$" in place for place in places)


class Restorer:
    """Readings of disguised tokens under a language model."""

    def __init__(self, costs: np.ndarray) -> None:
        self._costs = costs
        self._flat = costs.ravel().tolist()

    def _search(self, lattice: list[list[tuple[str, float]]]) -> str:
        """The likeliest path; each place of the lattice offers strings at a cost. A blank is an edge."""
        costs = self._flat
        # Per last two codes the best way there, as a chain of what was written.
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for options in [*lattice, [(" ", 0.0)]]:
            following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, path) in best.items():
                for written, own in options:
                    total, x, y = cost + own, a, b
                    for c in written:
                        code = 0 if c == " " else _CODE.get(c, _OTHER)
                        total += costs[(x * _N + y) * _N + code]
                        x, y = y, code
                    if total < following.get((x, y), (math.inf, None))[0]:
                        following[x, y] = (total, (path, written) if written else path)
            best = following
        path, parts = min(best.values(), key=lambda found: found[0])[1], []
        while path is not None:
            path, written = path
            parts.append(written)
        return "".join(reversed(parts)).strip()

    def _options(self, token: str) -> Iterator[list[tuple[str, float]]]:
        """Place by place what a token may stand for, at a cost."""
        at = 0
        while at < len(token):
            c, run = token[at], 1
            while at + run < len(token) and token[at + run] == c:
                run += 1
            at += run
            if c.isalpha():
                yield [(c, 0.0)] if run == 1 else [(c, REPEAT_COST), (c + c, REPEAT_COST * (run > 2))]
            elif c == " ":
                yield [("", DROP_COST), (" ", KEEP_COST)]
            elif c not in STANDS_FOR:
                yield [("", MARK_COST)]
            elif run == 1:
                yield [(x, SIGN_COST) for x in STANDS_FOR[c]]
            else:
                yield [(x * k, SIGN_COST + REPEAT_COST * (k < run)) for x in STANDS_FOR[c] for k in (1, 2)]

    def _lattice(self, token: str) -> list[list[tuple[str, float]]]:
        return list(self._options(token))

    def restore_outer(self, before: str, core: str, after: str, tree: Tree | None = None) -> str:
        """The likeliest reading of a token between signs that are letters or nothing; none if it can't be in the tree."""
        if tree and not tree.holds(chain(_outer(before), self._options(core), _outer(after))):
            return ""
        return self._search([*_outer(before), *self._options(core), *_outer(after)])

    def restore(self, token: str) -> str:
        """The likeliest reading of a token in lower case, or of tokens with one blank between."""
        return self._search(self._lattice(token))


def _outer(signs: str) -> list[list[tuple[str, float]]]:
    """Places of signs at the edge of a token: each may be a letter it stands for, or nothing."""
    return [[("", MARK_COST), *((x, SIGN_COST) for x in STANDS_FOR.get(c, ""))] for c in signs]


def _readings(token: str, restorer: Restorer, tree: Tree | None = None) -> set[str]:
    """The words a token may be meant as: what it restores to, with signs at its edges as letters or as nothing, and its parts.

    With a ``tree`` only readings matter that hold one of its parts, so a lattice that spells none is not searched.
    """
    core = token.strip(_EDGES)
    at = token.find(core) if core else len(token)
    # Marks that stand for no letter go.
    before = "".join(c for c in token[:at] if c in STANDS_FOR)
    after = "".join(c for c in token[at + len(core) :] if c in STANDS_FOR)
    parts = set(_PLAIN.findall(core))
    plain = _PLAIN.fullmatch(core)
    found = parts.copy()
    if (plain and _TWICE.search(core)) or (not plain and any(c.isalpha() or c in STANDS_FOR for c in core)):
        found |= set(restorer.restore_outer("", core, "", tree).split())
    if (before or after) and (core or len(before) > 1):
        found |= set(restorer.restore_outer(before, core, after, tree).split())
    return found


@lru_cache(1 << 15)
def _single(token: str) -> str:
    """The one letter, or sign that may be one, that a token consists of but for marks at its edges; else nothing."""
    core = token if len(token) == 1 else token.strip(_EDGES)
    return core if len(core) == 1 and (core.isalpha() or core in STANDS_FOR) else ""


def _spelled(tokens: list[str]) -> list[str]:
    """Runs of three or more tokens of one character, each joined by blanks."""
    found, run = [], []
    cores = ["" if len(t) > 1 and t.isalpha() else _single(t) for t in tokens]
    if b"\1\1\1" not in bytes(map(bool, cores)):
        return found
    for core in [*cores, ""]:
        if core:
            run.append(core)
            continue
        if len(run) > 2:
            found.append(" ".join(run))
        run = []
    return found


def parts_of(word: str) -> list[str]:
    """A word, marked as whole, and its beginnings."""
    return [f"{word}$", *(word[:k] for k in range(SHORTEST_PART, min(LONGEST_PART, len(word)) + 1))]


def _is_plain(token: str, core: str) -> bool:
    """Whether a token can only be read as it is written: letters, none doubled, and no sign that may be a letter."""
    return core.isalpha() and (len(core) == len(token) or _SIGNS.isdisjoint(token)) and not _TWICE.search(core)


def _restored_words(
    text: str, restorer: Restorer, known: dict[str, set[str]], tree: Tree | None = None, dull: _Dull | None = None
) -> set[str]:
    """The words of a text: those written plainly, the readings of all other tokens, and of spelled-out runs.

    With a ``tree`` only words that hold its parts matter, and tokens that are ``dull`` for these parts are passed over.
    """
    lower = text.lower()
    words = set(_PLAIN.findall(lower))
    if tree is not None and tree.empty:
        return words
    tokens = lower.split()
    for token in set(tokens):
        if dull is not None and dull[token[:SHORTEST_PART]] and token.isalpha():
            continue
        if _is_plain(token, token.strip(_EDGES)):
            continue
        found = known.get(token)
        if found is None:
            if len(known) >= REMEMBERED_READINGS:
                known.clear()
            found = known[token] = _readings(token, restorer, tree)
        words |= found
    for run in _spelled(tokens):
        words |= set(restorer.restore(run).split())
    return words


def _skeleton(word: str) -> str:
    """A word with every letter once where it is repeated; readings of repeated letters share it."""
    return _REPEATED.sub(r"\1", word)


class _Dull(dict):
    """By the first letters of a token of letters only whether it can't carry weight, nor begin a word that does.

    Letters that are not doubled are read as they are written, so they tell.
    """

    def __init__(self, weights: Weights) -> None:
        super().__init__()
        self._weights = weights

    def __missing__(self, head: str) -> bool:
        known = self._weights
        plain = len(head) > 1 and head.isalpha() and not _TWICE.search(head)
        weighs = head in known.starts if len(head) == SHORTEST_PART else known.of_word(head) > 0
        self[head] = found = plain and not weighs and head not in known.beginnings
        return found


class Weights(dict):
    """Weight of a token: that of the weightiest part of any of its readings. Filled as tokens are met."""

    def __init__(self, weights: dict[str, float], restorer: Restorer) -> None:
        super().__init__()
        self._weights, self._restorer = weights, restorer
        self._whole = {part[:-1]: weight for part, weight in weights.items() if part.endswith("$")}
        self._longest, self._joined = max(map(len, self._whole), default=0), {}
        self._tree, self._words = Tree(weights), Tree(f"{word}$" for word in self._whole)
        # How weighted parts begin; and every beginning of a weighted whole word. Both also without repeated letters.
        parts = [part.removesuffix("$") for part in weights]
        self.starts = {part[:SHORTEST_PART] for part in parts}
        self._bare_starts = {_skeleton(part)[:SHORTEST_PART] for part in parts}
        self.beginnings = {word[:k] for word in self._whole for k in range(1, len(word) + 1)}
        self._bare_beginnings = set(map(_skeleton, self.beginnings))
        self.dull = _Dull(self)
        # Of the tokens met: those a weighted word may begin with, without their edges; and those of one character.
        self._begins: dict[str, str] = {}
        self._singles: set[str] = set()

    def of_word(self, word: str) -> float:
        if word[:SHORTEST_PART] not in self.starts:
            return 0.0
        return max((self._weights.get(part, 0.0) for part in parts_of(word)), default=0.0)

    def __missing__(self, token: str) -> float:
        core = token.strip(_EDGES)
        if _is_plain(token, core) or (core.isalpha() and _SIGNS.isdisjoint(token) and not self._may_weigh(_skeleton(core))):
            weight = self.of_word(core)
        else:
            weight = max(map(self.of_word, _readings(token, self._restorer, self._tree)), default=0.0)
        self[token] = weight
        if len(core or token) < self._longest and self._goes_on(core or token):
            self._begins[token] = core or token
        if _single(token):
            self._singles.add(token)
        return weight

    def _may_weigh(self, skeleton: str) -> bool:
        return any(skeleton[:n] in self._bare_starts for n in range(1, SHORTEST_PART + 1))

    def _of_joined(self, joined: str) -> float:
        """Weight of neighbouring tokens read as one whole word."""
        if joined.isalpha():
            return self._whole.get(joined, 0.0)
        found = self._joined.get(joined)
        if found is None:
            if len(self._joined) >= REMEMBERED:
                self._joined.clear()
            held = self._words.holds(self._restorer._options(joined))
            found = self._joined[joined] = self._whole.get(self._restorer.restore(joined), 0.0) if held else 0.0
        return found

    def _goes_on(self, run: str) -> bool:
        """Whether a weighted whole word may be read as beginning like this."""
        if run.isalpha():
            if run in self.beginnings:
                return True
            if not _TWICE.search(run) or _skeleton(run) not in self._bare_beginnings:
                return False
        return bool(self._words.walk(self._restorer._options(run))[1])

    def _of_neighbours(self, tokens: list[str]) -> float:
        """Weight of whole words with blanks in them; runs of single characters are read elsewhere.

        A run of neighbours ends where no weighted word begins like it.
        """
        total = 0.0
        for at in compress(range(len(tokens) - 1), map(self._begins.__contains__, tokens)):
            joined = self._begins[tokens[at]]
            for n, other in enumerate(tokens[at + 1 : at + self._longest], 2):
                core = other.strip(_EDGES) or other
                joined += core
                if len(joined) > self._longest or not self._goes_on(joined):
                    break
                if not all(c.isalpha() or c in STANDS_FOR for c in core):
                    break
                if len(joined) > n:
                    total += self._of_joined(joined)
        return total

    def of_text(self, text: str) -> float:
        if len(self) >= REMEMBERED:
            for known in (self, self._begins, self._singles):
                known.clear()
        lower = text.lower()
        for ending in _ENDINGS:
            lower = lower.replace(ending, ending[-1])
        tokens, dull = lower.split(), self.dull
        odd = [t for t in tokens if not (dull[t[:SHORTEST_PART]] and t.isalpha())]
        total = sum(map(self.__getitem__, odd)) + self._of_neighbours(tokens)
        if b"\1\1\1" in bytes(map(self._singles.__contains__, tokens)):
            for run in _spelled(tokens):
                total += sum(map(self.of_word, self._restorer.restore(run).split()))
        return total


def _evidence(total: float) -> float:
    """What the calibration sees of a document's weight."""
    return math.log1p(min(total, MOST_HITS * math.log(LEAST_RATIO)))


def _calibrated(rows: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Intercept and slope of a logistic curve through (evidence, label, number of rows), slightly held back."""
    if not rows:
        return math.log(0.01), 3.0
    x, y, n = (np.array(c, float) for c in zip(*rows, strict=True))
    design = np.stack([np.ones_like(x), x], axis=1)
    ridge = np.diag([1e-4, 1e-2])

    def loss(theta: np.ndarray) -> float:
        margin = design @ theta
        return float((n * (np.logaddexp(0, margin) - y * margin)).sum() + theta @ ridge @ theta / 2)

    theta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -500, 500)))
        slope = design.T @ (n * (y - p)) - ridge @ theta
        curve = design.T @ (design * (n * p * (1 - p))[:, None]) + ridge
        step, length = np.linalg.solve(curve, slope), 1.0
        while loss(theta + length * step) > loss(theta) and length > 1e-6:
            length /= 2
        theta = theta + length * step
        if abs(length * step).max() < 1e-6:
            break
    return float(theta[0]), float(theta[1])


def _held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 3 == 1, F.lit(False))


def _training(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic of the training rows: labelled ones that are not held out, a bounded number by hash."""
    usable = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~_held_out())
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    share = int(min(1.0, TRAINING_ROWS / max(1, usable.count())) * (1 << 30))
    chosen = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    # About TRAINING_ROWS rows of two numbers.
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    return stored(rows.select("text", "toxic"), "training")


def _weights(training: DataFrame, costs) -> dict[str, float]:
    """Weights of the parts of words that mark toxic training rows."""
    totals = {row.toxic: row.n for row in training.groupBy("toxic").agg(F.count("*").alias("n")).collect()}

    def counting(parts, tree):
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            restorer, known, counts = Restorer(costs.value), {}, Counter()
            wanted = None if parts is None else parts.value
            own_tree = None if parts is None else Tree(wanted if tree else ())
            dull = Weights(dict.fromkeys(wanted, 1.0), restorer).dull if tree else None
            starts = None if wanted is None else {part.removesuffix("$")[:SHORTEST_PART] for part in wanted}

            def counted() -> pa.RecordBatch:
                columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
                return pa.RecordBatch.from_arrays(columns, ["part", "n"])

            for batch in batches:
                for text in batch.column("text"):
                    words = _restored_words(text.as_py(), restorer, known, own_tree, dull)
                    if starts is not None:
                        words = [word for word in words if word[:SHORTEST_PART] in starts]
                    own = {part for word in words for part in parts_of(word)}
                    counts.update(own if wanted is None else own & wanted)
                    if len(counts) >= COUNTED_PARTS:
                        yield counted()
                        counts.clear()
            yield counted()

        return count

    def rows_with(label: int, parts: Iterable[str] | None, tree: bool, least: int) -> dict[str, int]:
        texts = training.filter(F.col("toxic") == label).select("text")
        shared = None if parts is None else training.sparkSession.sparkContext.broadcast(frozenset(parts))
        counted = texts.mapInArrow(counting(shared, tree), "part string, n bigint").groupBy("part").agg(F.sum("n").alias("n"))
        return {row.part: row.n for row in counted.filter(F.col("n") >= least).collect()}

    # Bounded by the training rows: parts that several toxic ones of them have.
    toxic = rows_with(1, None, False, LEAST_ROWS)
    # Clean rows are first read as they are written: a part that is too frequent there can't become less so by what
    # is restored, and for the few others few tokens have to be restored.
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    left = weights_of(toxic, rows_with(0, toxic, False, 1), n_toxic, n_clean)
    return weights_of({part: toxic[part] for part in left}, rows_with(0, left, True, 1), n_toxic, n_clean)


def weights_of(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Weights of parts from the numbers of toxic and clean rows that have them."""
    weights = {}
    for part, n in toxic.items():
        other = clean.get(part, 0)
        often, seldom = n - math.sqrt(n) + 0.5, other + math.sqrt(other) + 0.5
        ratio = often / (n_toxic + 1) / (seldom / (n_clean + 1))
        if n >= LEAST_ROWS and ratio >= LEAST_RATIO:
            weights[part] = math.log(ratio)
    return weights


def _scored(docs: DataFrame, labels: DataFrame, kept: list[str]) -> DataFrame:
    """Of every row ``row``, its columns ``kept``, and its ``score``."""
    spark = docs.sparkSession
    costs = spark.sparkContext.broadcast(_language_model(docs))  # one number per trigram of the alphabet
    training = _training(docs, labels)
    shared = spark.sparkContext.broadcast(_weights(training, costs))

    def weighed(rows: DataFrame, names: list[str]) -> DataFrame:
        def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights = Weights(shared.value, Restorer(costs.value))
            for batch in batches:
                found = [_evidence(weights.of_text(t.as_py())) for t in batch.column("text")]
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.float64())], ["row", "evidence"])

        # The caller's columns travel in one, so that their names meet no others.
        packed = rows.select(F.struct(*names).alias("row"), text_of().alias("text"))
        return packed.mapInArrow(weigh, packed.select("row").schema.add("evidence", T.DoubleType()))

    # Evidence lies between 0 and a constant; in steps of a hundredth there are a few hundred values.
    binned = weighed(training, ["toxic"]).groupBy(F.round("evidence", 2).alias("x"), "row.toxic").agg(F.count("*").alias("n"))
    intercept, slope = _calibrated([(r.x, r.toxic, r.n) for r in binned.collect()])
    score = 1 / (1 + F.exp(-(F.lit(intercept) + F.lit(slope) * F.col("evidence"))))
    return weighed(docs, kept).select("row", score.alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): doc_id, held_out, score (0 to 1) and predicted (0 or 1).

    ``labels`` (``doc_id``, ``toxic``) are learnt from where crc32(doc_id) modulo 3 is not 1; of the other
    rows, held_out, no label is looked at. Only the text counts for a score.

    Null and empty texts get the score of a text without evidence. A null doc_id stays null and is not
    held out; of a doc_id with several labels the toxic one counts; without labels nothing carries
    weight, and scores are low. Repeated rows give repeated rows; an empty table gives none. Texts of any
    length are read whole; weight beyond that of ``MOST_HITS`` plain hits no longer changes a score, which is
    close to 1 there. Other columns are not looked at.
    """
    scored = _scored(docs, labels, ["doc_id"])
    return scored.select(
        "row.doc_id",
        _held_out("row.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text scores ``threshold`` or more; scores are those of ``toxicity``.

    Null and empty texts stay, whole texts of any length are read, repeated rows go or stay together, an
    empty table stays empty. All columns are kept as they are, whatever their names.
    """
    return _scored(docs, labels, docs.columns).filter(F.col("score") < threshold).select("row.*")
