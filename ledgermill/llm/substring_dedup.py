"""Removal of passages that an earlier document has, by level-wise doubling.

A window of ``window`` words can only repeat where its shorter windows do. Lengths therefore double up
to ``window`` (its last step may be less than twice): at each length, all windows still alive look up
the smallest hash among their own windows of that length, and those whose smallest hash no other
document has are dropped. Copies of a window share that hash, so nothing that repeats is lost, and
neighbouring windows mostly share it too, so about a quarter of the positions is looked up at first
and a few at the full length, where two hashes of 64 bits stand for the words.

Documents travel in compressed blocks. A block asks once for each distinct hash, whatever number of its
windows has it, and is told one bit: whether another block knows it (at full length: with a smaller
doc_id). Hashes are dealt out by value, so a passage that a third of all documents share is one hash
per block in each of its places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.texts import words_of
from ledgermill.session import stored

WINDOW = 13
# The first length is the shortest one that doubling leads from and that is not below this.
SHORTEST = 7
BLOCK_BYTES = 4 << 20
# Words for which one task compares hashes, about.
BUCKET_WORDS = 8_000_000

_BLOCK_SCHEMA = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])


def lengths_to(window: int, shortest: int = SHORTEST) -> list[int]:
    """The lengths of the levels, each at most twice the one before."""
    found = [window]
    while (found[0] + 1) // 2 >= min(shortest, window) and found[0] > 1:
        found.insert(0, (found[0] + 1) // 2)
    return found


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(29)


def _hashes(of_words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` words, by doubling."""
    found, at = of_words, 1
    while at < length:
        step = min(at, length - at)
        found, at = _mixed(found[: len(found) - step], found[step:]), at + step
    return found


def _smallest(values: np.ndarray, n: int) -> np.ndarray:
    """The smallest of each n neighbours."""
    at = 1
    while at < n:
        step = min(at, n - at)
        values, at = np.minimum(values[: len(values) - step], values[step:]), at + step
    return values


class Block:
    """Documents of a block in order of doc_id, as one run of words."""

    def __init__(self, payload: bytes, window: int) -> None:
        table = pa.ipc.open_stream(payload).read_all()
        rows = zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), strict=True)
        self.docs = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
        self.words = [words_of(text) for _, text in self.docs]
        self.window = window
        self.flat = [w for words in self.words for w in words]
        counts = np.array([len(words) for words in self.words], np.int64)
        self.ends = np.cumsum(counts)
        self.doc = np.repeat(np.arange(len(counts)), counts)
        self.ids = np.array([0 if d is None else d for d, _ in self.docs], np.int64)
        known = np.array([d is not None for d, _ in self.docs], bool)
        at = np.arange(len(self.flat))
        self.alive = at[(at + window <= self.ends[self.doc]) & known[self.doc]]
        self._of_words: dict[int, np.ndarray] = {}

    def _word_hashes(self, seed: int) -> np.ndarray:
        if seed not in self._of_words:
            digest = xxhash.xxh64_intdigest
            self._of_words[seed] = np.fromiter((digest(w, seed) for w in self.flat), np.uint64, len(self.flat))
        return self._of_words[seed]

    def look_up(self, length: int) -> None:
        """The distinct hashes of the windows alive: ``keys`` (two columns), ``firsts`` and ``shared``."""
        n = self.window - length + 1
        if not len(self.alive):
            self.keys, self.firsts, self.shared = np.zeros((0, 2), np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
            self.key_of = np.zeros(0, np.int64)
            return
        own = _smallest(_hashes(self._word_hashes(0), length), n)[self.alive]
        # Only whole windows need the second hash: shorter ones are a filter.
        other = _hashes(self._word_hashes(1), length)[self.alive] if n == 1 else np.zeros_like(own)
        order = np.lexsort((self.alive, other, own))
        own, other, doc = own[order], other[order], self.doc[self.alive[order]]
        new = np.append(True, (own[1:] != own[:-1]) | (other[1:] != other[:-1]))
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(own)) - 1
        self.keys = np.stack([own[begin], other[begin]], axis=1)
        self.firsts = self.ids[doc[begin]]
        self.shared = doc[begin] != doc[last]
        self.key_of = np.empty(len(order), np.int64)
        self.key_of[order] = np.cumsum(new) - 1

    def told(self, length: int, answers: dict[int, bytes], buckets: int) -> np.ndarray:
        """Keep the windows alive that repeat, given one bit per hash; says which hashes others have."""
        self.look_up(length)
        bucket = self.keys[:, 0] % np.uint64(buckets)
        elsewhere = np.zeros(len(self.keys), bool)
        for b, bits in answers.items():
            own = np.flatnonzero(bucket == b)
            elsewhere[own] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(own)).astype(bool)
        if length < self.window:
            self.alive = self.alive[(elsewhere | self.shared)[self.key_of]]
        else:
            later = self.ids[self.doc[self.alive]] > self.firsts[self.key_of]
            self.alive = self.alive[elsewhere[self.key_of] | later]
        return elsewhere

    def kept(self) -> Iterator[tuple[int | None, int, list[bytes]]]:
        """(doc_id, number of words, words kept) per document, with ``alive`` the windows to remove."""
        steps = np.zeros(len(self.flat) + 1, np.int64)
        np.add.at(steps, self.alive, 1)
        np.add.at(steps, self.alive + self.window, -1)
        stays = np.cumsum(steps[:-1]) == 0
        begin = 0
        for (doc_id, _), words, end in zip(self.docs, self.words, self.ends.tolist(), strict=True):
            own = stays[begin:end]
            yield doc_id, len(words), words if own.all() else [w for w, s in zip(words, own.tolist(), strict=True) if s]
            begin = end


def _blocks(docs: DataFrame) -> DataFrame:
    """block, n_words, payload: the documents in compressed blocks of bounded size."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, doc_ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def closed() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _BLOCK_SCHEMA, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(texts, pa.string())], schema=_BLOCK_SCHEMA))
            n_words = sum(len(words_of(t)) for t in texts)
            return pa.RecordBatch.from_pylist([{"block": block, "n_words": n_words, "payload": sink.getvalue().to_pybytes()}])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc_ids.append(doc_id)
                texts.append(text or "")
                size += len(texts[-1]) + 16
                if size >= BLOCK_BYTES:
                    yield closed()
                    block, doc_ids, texts, size = block + 1, [], [], 0
        if doc_ids:
            yield closed()

    return docs.select("doc_id", "text").mapInArrow(gather, "block bigint, n_words bigint, payload binary")


def _caught_up(row: dict, window: int, lengths: list[int], buckets: int) -> Block:
    """The block of a row after the levels it has answers for, those of ``lengths``."""
    block = Block(row["payload"], window)
    answers: dict[int, dict[int, bytes]] = {n: {} for n in lengths}
    for a in row["answers"] or []:
        answers[a["length"]][a["bucket"]] = a["bits"]
    for n in lengths:
        block.told(n, answers[n], buckets)
    return block


def _questions(blocks: DataFrame, window: int, done: list[int], length: int, buckets: int) -> DataFrame:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                block = _caught_up(row, window, done, buckets)
                block.look_up(length)
                bucket = (block.keys[:, 0] % np.uint64(buckets)).astype(np.int64)
                whole = length == window
                rows = []
                for b in np.unique(bucket).tolist():
                    own = bucket == b
                    keys, firsts = block.keys[own], block.firsts[own]
                    rows.append(
                        {
                            "bucket": b,
                            "block": row["block"],
                            "keys": keys.tobytes() if whole else keys[:, 0].tobytes(),
                            "firsts": firsts.tobytes() if whole else b"",
                        }
                    )
                if rows:
                    yield pa.RecordBatch.from_pylist(rows)

    return blocks.mapInArrow(ask, "bucket bigint, block bigint, keys binary, firsts binary")


def _answers(questions: DataFrame, whole: bool, length: int) -> DataFrame:
    """One bit per hash asked for: whether another block has it (whole windows: with a smaller doc_id)."""

    def answer(table: pa.Table) -> pa.Table:
        asked = [np.frombuffer(k, np.uint64) for k in table.column("keys").to_pylist()]
        if whole:
            asked = [k.reshape(-1, 2) for k in asked]
            keys = np.concatenate(asked)
            firsts = np.concatenate([np.frombuffer(f, np.int64) for f in table.column("firsts").to_pylist()])
            order = np.lexsort((firsts, keys[:, 1], keys[:, 0]))
            new = np.append(True, (keys[order[1:]] != keys[order[:-1]]).any(1))
            smallest = firsts[order][np.flatnonzero(new)][np.cumsum(new) - 1]
            found = np.empty(len(keys), bool)
            found[order] = firsts[order] > smallest
        else:
            keys = np.concatenate(asked)
            order = np.argsort(keys, kind="stable")
            same = keys[order[1:]] == keys[order[:-1]]
            found = np.empty(len(keys), bool)
            found[order] = np.append(same, False) | np.append(False, same)
        cuts = np.cumsum([len(k) for k in asked])[:-1]
        bits = [np.packbits(part).tobytes() for part in np.split(found, cuts)]
        n = len(bits)
        return pa.table(
            {
                "block": table.column("block"),
                "length": pa.array([length] * n, pa.int32()),
                "bucket": table.column("bucket"),
                "bits": pa.array(bits, pa.binary()),
            }
        )

    return questions.groupBy("bucket").applyInArrow(answer, "block bigint, length int, bucket bigint, bits binary")


def remove_repeats(docs: DataFrame, window: int = WINDOW, shortest: int = SHORTEST) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): doc_id, n_words, n_removed, kept_text.

    A word goes if some window of ``window`` words of its document that covers it also begins in a
    document with a smaller doc_id, judged on the texts as they came. kept_text is the other words,
    joined by one blank.

    Null texts have no words. A row without doc_id is neither cut nor a reason to cut; rows with the
    same doc_id are no reason to cut each other; texts shorter than the window stay. Texts of any length
    are taken whole. An empty table gives no rows. Other columns are not looked at.
    """
    blocks = stored(_blocks(docs), "blocks")
    n_words = blocks.agg(F.sum("n_words")).first()[0] or 0
    buckets = n_words // BUCKET_WORDS + 16
    lengths = lengths_to(window, shortest)
    answers = None

    def with_answers() -> DataFrame:
        if answers is None:
            return blocks.withColumn("answers", F.lit(None).cast("array<struct<length:int,bucket:bigint,bits:binary>>"))
        # A block gets as many bits as it has asked for hashes, at most one per word.
        told = answers.groupBy("block").agg(F.collect_list(F.struct("length", "bucket", "bits")).alias("answers"))
        return blocks.join(told, "block", "left")

    for n, length in enumerate(lengths):
        asked = _questions(with_answers(), window, lengths[:n], length, buckets)
        new = stored(_answers(asked, length == window, length), "answers")
        answers = new if answers is None else answers.unionByName(new)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                block = _caught_up(batch.slice(n, 1).to_pylist()[0], window, lengths, buckets)
                rows = [(d, count, count - len(kept), b" ".join(kept).decode()) for d, count, kept in block.kept()]
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                    ["doc_id", "n_words", "n_removed", "kept_text"],
                )

    return with_answers().mapInArrow(remove, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")
