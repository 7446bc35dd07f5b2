"""Language-model scoring with sharded Elias-Fano n-gram tries.

The counts of the whole training corpus make the model, so it grows with the corpus and no
machine holds it. Documents are cut into blocks of tokens. A block sends its distinct words,
and later its distinct pairs, once to the shards that count them; a shard adds up what all
blocks sent, makes its trie (contexts, monotone pointers, successors and quantised smoothed
probabilities) and answers every block from it. Blocks then score their documents.

A pair's shard is chosen by its context, and a context with many tokens is spread over shards
by its words, so no context is too large for one. A word or pair is one entry per block, however
often it occurs there.

Probability of word w after v: (c(v, w) + M p(w)) / (c(v) + M). The tries hold the first part,
c(v, w) / (c(v) + M), in 8 bits; p(w) is (c(w) - D) / N, and D V / N for any unknown word. A
document starts from a start context and ends with an end token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.arrow import column
from tarmac.llm.columns import written
from tarmac.llm.elias_fano import BigramTrie
from tarmac.llm.groups import boundaries, runs
from tarmac.llm.words import chunks, mix, word_hashes

# Tokens of a block, and tokens for each shard.
BLOCK_TOKENS, SHARD_TOKENS, LEAST_SHARDS = 400_000, 1_500_000, 12
BLOCKS_PER_TASK = 4
PRIOR, DISCOUNT = 100.0, 0.5
_END = np.uint64(0x6A09E667F3BCC908)

_BLOCKS = "block bigint, docs binary, flags binary, sizes binary, vocabulary binary, tokens binary, trained bigint"
_MESSAGE = "shard int, block bigint, a binary, b binary, c binary"
_REPLY = "block bigint, kind int, shard int, a binary, b binary, words bigint, known bigint"
_SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double")


def _pack(array: np.ndarray) -> bytes:
    """Type, number and content, compressed; integers as narrow as they can be, high bytes apart from low ones."""
    if array.dtype.kind in "ui" and len(array):
        array = array.astype(np.min_scalar_type(array.max()))
    raw = np.ascontiguousarray(array).view(np.uint8).reshape(-1, array.itemsize).T.tobytes()
    return array.dtype.char.encode() + len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[1:9], "little")
    kind = np.dtype(data[:1].decode())
    if not size:
        return np.zeros(0, kind)
    raw = np.frombuffer(pa.decompress(data[9:], size, "zstd"), np.uint8)
    return np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).view(kind).ravel()


def _pack_sorted(array: np.ndarray) -> bytes:
    """As ``_pack``, for numbers that do not fall."""
    return _pack(np.diff(array, prepend=array.dtype.type(0)))


def _unpack_sorted(data: bytes, kind: type = np.int64) -> np.ndarray:
    return np.cumsum(_unpack(data), dtype=kind)


def _record(ddl: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(),
             "boolean": pa.bool_()}
    fields = [f.strip().split(" ") for f in ddl.split(",")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _cut(block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        parts: list[tuple] = []
        size = 0
        for batch in batches:
            texts, ids, train, held = (column(batch, c) for c in ("text", "doc_id", "train", "held_out"))
            for begin, stop in chunks(texts):
                part = slice(begin, stop)
                words, at = word_hashes(texts[part])
                tokens = np.insert(words, at[1:], _END)
                flags = np.asarray(train[part]).astype(np.uint8) | np.asarray(ids[part].is_null()).astype(np.uint8) * 2
                flags |= np.asarray(held[part]).astype(np.uint8) * 4
                parts.append((np.asarray(ids[part].fill_null(0)), flags, np.diff(at) + 1, tokens))
                size += len(tokens)
                if size >= block_tokens:
                    yield _record(_BLOCKS, [_block(number, parts)])
                    number, parts, size = number + 1, [], 0
        if parts:
            yield _record(_BLOCKS, [_block(number, parts)])
    return run


def _block(number: int, parts: list[tuple]) -> tuple:
    docs, flags, sizes, tokens = (np.concatenate(p) for p in zip(*parts, strict=True))
    vocabulary, local = np.unique(tokens, return_inverse=True)
    trained = int(sizes[flags & 1 > 0].sum())
    return (number, docs.astype(np.int64).tobytes(), _pack(flags), _pack(sizes), _pack_sorted(vocabulary), _pack(local), trained)


def _word_messages(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                flags, sizes, tokens = (_unpack(row[c]) for c in ("flags", "sizes", "tokens"))
                words = _unpack_sorted(row["vocabulary"], np.uint64)
                train = np.repeat(flags & 1, sizes) > 0
                counts = np.bincount(tokens[train], minlength=len(words))
                shard = ((words >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(int)
                at = np.searchsorted(shard, np.arange(shards + 1))
                yield _record(_MESSAGE, [
                    (s, row["block"], _pack_sorted(words[a:b]), _pack(counts[a:b]), b"")
                    for s, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if b > a])
    return run


def _word_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's words in order, with their counts; each block learns the places and counts of its own."""
    for table in runs(batches, ["shard"]):
        at = boundaries(table, ["shard"])
        for begin, stop in zip(at[:-1], at[1:], strict=True):
            part = table.slice(begin, stop - begin)
            words = [_unpack_sorted(x.as_py(), np.uint64) for x in part["a"]]
            counts = np.concatenate([_unpack(x.as_py()).astype(np.int64) for x in part["b"]])
            known, place = np.unique(np.concatenate(words), return_inverse=True)
            total = np.bincount(place, counts, len(known)).astype(np.int64)
            ends = np.cumsum([len(w) for w in words])
            out = []
            for i, (block, w, end) in enumerate(zip(part["block"].to_pylist(), words, ends, strict=True)):
                own = place[end - len(w):end]
                # The shard's own numbers go with its first answer.
                size, seen = (len(known), int((total > 0).sum())) if i == 0 else (0, 0)
                out.append((block, 1, part["shard"][0].as_py(), _pack_sorted(own), _pack(total[own]), size, seen))
            yield _record(_REPLY, out)


class _Block:
    """A block's tokens as numbers of the whole corpus, with their counts, and its distinct pairs."""

    def __init__(self, rows: pa.Table, offsets: np.ndarray, facts: dict) -> None:
        rows = rows.to_pylist()
        content = next(r for r in rows if r["kind"] == 0)
        replies = sorted((r for r in rows if r["kind"] == 1), key=lambda r: r["shard"])
        self.number = content["block"]
        self.docs = np.frombuffer(content["docs"], np.int64)
        self.flags, self.sizes = _unpack(content["flags"]), _unpack(content["sizes"]).astype(np.int64)
        words = np.concatenate([_unpack_sorted(r["a"]) + offsets[r["shard"]] for r in replies])
        counts = np.concatenate([_unpack(r["b"]).astype(np.int64) for r in replies])
        tokens = _unpack(content["tokens"])
        self.word, self.count = words[tokens], counts[tokens]
        self.first = np.cumsum(self.sizes) - self.sizes
        start, self.facts = int(offsets[-1]), facts
        before, of = np.roll(self.word, 1), np.roll(self.count, 1)
        before[self.first], of[self.first] = start, facts["train_docs"]
        width = np.uint64(start + 1)
        key, self.place = np.unique(before.astype(np.uint64) * width + self.word.astype(np.uint64), return_inverse=True)
        self.context, self.next = (key // width).astype(np.int64), (key % width).astype(np.int64)
        train = np.repeat(self.flags & 1, self.sizes) > 0
        self.pairs = np.bincount(self.place[train], minlength=len(key))
        self.before = of  # the context's count, by token
        self.context_count = np.zeros(len(key), np.int64)
        self.context_count[self.place] = of
        share = self.context_count * (4 * facts["shards"]) // max(facts["train_tokens"], 1) + 1
        spread = mix(self.next.astype(np.uint64)) % share.astype(np.uint64)
        self.shard = (mix(self.context.astype(np.uint64) * np.uint64(1 << 20) + spread)
                      % np.uint64(facts["shards"])).astype(np.int32)
        self.order = np.argsort(self.shard, kind="stable")


def _pair_messages(offsets: np.ndarray, facts: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["block"]):
            at = boundaries(table, ["block"])
            for begin, stop in zip(at[:-1], at[1:], strict=True):
                block = _Block(table.slice(begin, stop - begin), offsets, facts)
                shard = block.shard[block.order]
                out = []
                ends = np.searchsorted(shard, np.arange(facts["shards"] + 1))
                for s, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                    if b > a:
                        part = block.order[a:b]
                        context = block.context[part]
                        new = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
                        runs_ = np.stack([np.diff(context[new], prepend=0), np.diff(np.r_[new, b - a]), block.context_count[part][new]])
                        out.append((s, block.number, _pack(runs_.ravel()), _pack(block.next[part]), _pack(block.pairs[part])))
                yield _record(_MESSAGE, out)
    return run


def shard_trie(context: np.ndarray, word: np.ndarray, count: np.ndarray, context_count: np.ndarray, width: int) -> bytes:
    """The trie of a shard from sorted pairs that were seen in training, as a flat buffer."""
    return BigramTrie.build(context, word, np.log10(count / (context_count + PRIOR)), width)


def _pair_shards(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["shard"]):
            at = boundaries(table, ["shard"])
            for begin, stop in zip(at[:-1], at[1:], strict=True):
                part = table.slice(begin, stop - begin)
                heads = [_unpack(x.as_py()).reshape(3, -1).astype(np.int64) for x in part["a"]]
                word = np.concatenate([_unpack(x.as_py()).astype(np.int64) for x in part["b"]])
                count = np.concatenate([_unpack(x.as_py()).astype(np.int64) for x in part["c"]])
                context = np.concatenate([np.repeat(np.cumsum(h[0]), h[1]) for h in heads])
                of = np.concatenate([np.repeat(h[2], h[1]) for h in heads])
                seen = count > 0
                key, place = np.unique(
                    context[seen].astype(np.uint64) * np.uint64(width) + word[seen].astype(np.uint64), return_inverse=True)
                total = np.bincount(place, count[seen], len(key))
                context_count = np.zeros(len(key))
                context_count[place] = of[seen]
                trie = BigramTrie(shard_trie(
                    (key // np.uint64(width)).astype(np.int64), (key % np.uint64(width)).astype(np.int64),
                    total, context_count, width))
                out, row = [], 0
                for block, h in zip(part["block"].to_pylist(), heads, strict=True):
                    n = int(h[1].sum())
                    codes = trie.lookup(context[row:row + n], word[row:row + n])
                    out.append((block, 2, part["shard"][0].as_py(), _pack(codes), trie.scale.tobytes(), 0, 0))
                    row += n
                yield _record(_REPLY, out)
    return run


def _score(offsets: np.ndarray, facts: dict):
    n, v = facts["train_tokens"], facts["train_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["block"]):
            at = boundaries(table, ["block"])
            for begin, stop in zip(at[:-1], at[1:], strict=True):
                part = table.slice(begin, stop - begin)
                block = _Block(part, offsets, facts)
                answers = sorted((r for r in part.to_pylist() if r["kind"] == 2), key=lambda r: r["shard"])
                seen = []
                for r in answers:
                    low, step = np.frombuffer(r["b"])
                    codes = _unpack(r["a"])
                    seen.append(np.where(codes > 0, 10 ** (low + (codes.astype(float) - 1) * step), 0.0))
                share = np.empty(len(block.context))
                share[block.order] = np.concatenate(seen)
                unigram = np.where(block.count > 0, block.count - DISCOUNT, DISCOUNT * v) / n if n else np.ones(len(block.count))
                probability = share[block.place] + PRIOR / (block.before + PRIOR) * unigram
                score = np.add.reduceat(np.log10(probability), block.first)
                base = np.add.reduceat(np.log10((block.count + 1) / (n + v + 1)), block.first)
                known = np.add.reduceat((block.count > 0).astype(np.int64), block.first)
                missing = block.flags & 2 > 0
                yield pa.RecordBatch.from_arrays([
                    pa.array(block.docs, pa.int64(), mask=missing), pa.array((block.flags & 4) > 0),
                    pa.array(block.sizes), pa.array(known), pa.array(np.full(len(known), n)),
                    pa.array(base), pa.array(score)],
                    names=[f.strip().split(" ")[0] for f in _SCORES.split(", ")])
    return run


def score_documents(docs: DataFrame, held_out: Column, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Scores of every row (doc_id, text); the model learns from the rows where ``held_out`` is false.

    A row whose ``held_out`` is NULL is neither kept out nor learned from.

    Tokens are A-Z lowered words apart by space or 0x09-0x0D, and an end token; NULL texts are
    empty. n_known and base_score (add-one unigram) use exact counts of the training rows; score
    is the log10 probability of the trie model. Without training rows every word is unknown, and
    has probability 1 in both. Repeated rows are scored, and learned from, once each.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                        (~F.coalesce(held_out, F.lit(True))).alias("train"),
                        F.coalesce(held_out, F.lit(False)).alias("held_out"))
    blocks = written(texts.mapInArrow(_cut(block_tokens), _BLOCKS), "blocks")
    rows = blocks.agg(F.sum("trained").alias("n"), F.count(F.lit(1)).alias("blocks")).first()
    tokens = int(rows.n or 0)
    shards = max(LEAST_SHARDS, -(-max(tokens, (rows.blocks or 0) * block_tokens) // SHARD_TOKENS))
    replies = written(
        blocks.select("block", "flags", "sizes", "vocabulary", "tokens")
        .mapInArrow(_word_messages(shards), _MESSAGE)
        .repartitionById(shards, "shard").sortWithinPartitions("shard", "block")
        .mapInArrow(_word_shards, _REPLY), "words")
    sizes = replies.groupBy("shard").agg(F.sum("words").alias("words"), F.sum("known").alias("known")).collect()
    offsets = np.zeros(shards + 1, np.int64)
    for r in sizes:  # a row per shard
        offsets[r.shard + 1] = r.words
    offsets = np.cumsum(offsets)
    train_docs = docs.filter(~F.coalesce(held_out, F.lit(True))).count()
    facts = {"train_tokens": tokens, "train_words": sum(r.known for r in sizes), "train_docs": train_docs, "shards": shards}
    tasks = max(LEAST_SHARDS, (rows.blocks or 0) // BLOCKS_PER_TASK)
    content = blocks.select(
        "block", F.lit(0).alias("kind"), F.lit(0).alias("shard"), "docs", "flags", "sizes", "tokens",
        F.lit(None).cast("binary").alias("a"), F.lit(None).cast("binary").alias("b"))

    def answers(frame: DataFrame) -> DataFrame:
        none = [F.lit(None).cast("binary").alias(c) for c in ("docs", "flags", "sizes", "tokens")]
        return frame.select("block", "kind", "shard", *none, "a", "b")

    def by_block(frame: DataFrame) -> DataFrame:
        return frame.repartition(tasks, "block").sortWithinPartitions("block", "kind", "shard")

    joined = content.unionByName(answers(replies))
    pairs = written(
        by_block(joined).mapInArrow(_pair_messages(offsets, facts), _MESSAGE)
        .repartitionById(shards, "shard").sortWithinPartitions("shard", "block")
        .mapInArrow(_pair_shards(int(offsets[-1]) + 1), _REPLY), "pairs")
    return by_block(joined.unionByName(answers(pairs))).mapInArrow(_score(offsets, facts), _SCORES)
