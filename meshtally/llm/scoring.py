"""Language-model scores by a weighted backoff automaton.

Words, word pairs and triples of the training texts are counted over the whole corpus.
Each task turns its texts once into blocks of word numbers. A block sends the sorted hashes
of its distinct n-grams, cut into hash ranges, to the shards of the hash space; a shard
sums the counts of all blocks and answers each with the totals that it asked for. So a
block holds just the part of the model that its own texts can reach, and no task holds the
model. There it is an automaton: the root, the words and the pairs seen in training are
states; arcs carry smoothed log-probabilities; failure arcs lead from a pair to its last
word and from a word to the root at the price of the state's backoff weight. In one
left-to-right traversal each position starts from the state that its predecessor reached.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshtally.llm.common import held_out, stored
from meshtally.llm.minhash import mixed

PRIOR = 4.0  # observations that the shorter context's estimate is worth
BLOCK = 6 << 20  # characters of a block
SHARD = 3 << 20  # n-grams of all blocks that a shard answers, about
PER_TOKEN = 1.75  # distinct n-grams of a block by token, about
ORDERS = 3
KEPT_BITS = (64, 48, 48)  # of the hashes of words, pairs and triples
END_HASH = xxhash.xxh3_64_intdigest(b"end", seed=1)
START_HASH = xxhash.xxh3_64_intdigest(b"start", seed=2)
ROOT, WORD, PAIR = range(3)  # levels of states


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes; equal high bytes cost nothing."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes(), 1)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(bytearray(zstandard.decompress(data)), np.uint8)
    planes = planes.reshape(size, len(planes) // size)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def encoded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of each text, the block's own number of each token, and the hash of each number.

    Every text is its words, then an end. The last two numbers are the end and the start.
    """
    number: dict[bytes, int] = {}
    put, flat, lengths = number.setdefault, [], []
    for t in texts:
        words = (t or "").encode().lower().split()  # bytes: ASCII letters and white space only
        flat += [put(w, len(number)) for w in words]
        flat.append(-1)
        lengths.append(len(words) + 1)
    numbers = np.array(flat, np.int64)
    numbers[numbers < 0] = len(number)
    hashes = np.array([*map(xxhash.xxh3_64_intdigest, number), END_HASH, START_HASH], np.uint64)
    return np.array(lengths, np.uint32), numbers.astype(np.uint32), hashes


class Block:
    """Distinct n-grams of a block by ascending hash, and the place of each token's own among them.

    keys[k], which[k], for words, pairs and triples. A start stands before the first word; a
    first word has no triple, and its place there says nothing.
    """

    def __init__(self, lengths: np.ndarray, numbers: np.ndarray, hashes: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        here = hashes[numbers]
        before = np.concatenate([hashes[-1:], here[:-1]])
        before[self.first] = hashes[-1]
        earlier = np.concatenate([hashes[-1:], before[:-1]])
        earlier[self.first] = hashes[-1]
        pair = mixed(mixed(before) + here)
        each = (mixed(here), pair, mixed(mixed(mixed(earlier) + np.uint64(1)) + pair))
        self.keys, self.which = [], []
        for bits, key in zip(KEPT_BITS, each):
            keys, which = np.unique(key >> np.uint64(64 - bits), return_inverse=True)
            self.keys.append(keys)
            self.which.append(which)
        self.has_triple = np.ones(len(numbers), bool)
        self.has_triple[self.first] = False

    def own(self, train: np.ndarray) -> Iterator[np.ndarray]:
        """Counts of each order's keys in training texts."""
        trained = np.repeat(train, self.lengths)
        for k, which in enumerate(self.which):
            use = trained & self.has_triple if k == 2 else trained
            yield np.bincount(which[use], minlength=len(self.keys[k])).astype(np.uint32)

    def ranges(self, shards: int) -> list[np.ndarray]:
        """For each order the borders of the shards' hash ranges among its keys."""
        return [np.searchsorted(keys, np.array([-(-(s << bits) // shards) for s in range(1, shards)], np.uint64))
                for bits, keys in zip(KEPT_BITS, self.keys)]


class Automaton:
    """States and arcs that a block's texts can reach, from the training totals of block.keys.

    P(w) = (c(w) + 1) / (tokens + words + 1) at the root. In the state of a context h,
    P(w | h) = (c(h w) + PRIOR * P(w | h less its first word)) / (c(h) + PRIOR), so its
    failure arc weighs PRIOR / (c(h) + PRIOR) and the probabilities of each state add up to 1.
    """

    def __init__(self, block: Block, counts: list[np.ndarray], tokens: int, words: int, texts: int, prior: float):
        self.block = block
        one, two, three = (c[w].astype(float) for c, w in zip(counts, block.which))
        three[~block.has_triple] = 0
        self.count = one
        start = block.first
        # Counts of the contexts at each position: the word before it, and the pair before it.
        word_before, pair_before = np.concatenate([[0.0], one[:-1]]), np.concatenate([[0.0], two[:-1]])
        word_before[start], pair_before[start] = texts, 0
        self.root_arc = (one + 1) / (tokens + words + 1)
        self.word_arc = (two + prior * self.root_arc) / (word_before + prior)
        self.pair_arc = (three + prior * self.word_arc) / (pair_before + prior)
        self.word_fails, self.pair_fails = prior / (word_before + prior), prior / (pair_before + prior)
        self.has_arc = two > 0, three > 0
        # Where a position ends: the longest suffix that is a state.
        self.state_after = np.where(two > 0, PAIR, np.where(one > 0, WORD, ROOT))
        self.begin = WORD if texts else ROOT

    def traverse(self) -> np.ndarray:
        """log10 probability of each text of the block."""
        at = np.concatenate([[ROOT], self.state_after[:-1]])
        at[self.block.first] = self.begin
        weight = np.ones(len(at))
        # A pair without an arc for the word fails to its last word, a word without one to the root.
        fails = (at == PAIR) & ~self.has_arc[1]
        weight[fails] *= self.pair_fails[fails]
        at = np.where(fails, WORD, at)
        fails = (at == WORD) & ~self.has_arc[0]
        weight[fails] *= self.word_fails[fails]
        at = np.where(fails, ROOT, at)
        weight *= np.choose(at, (self.root_arc, self.word_arc, self.pair_arc))
        return np.add.reduceat(np.log10(weight), self.block.first)

    def base(self) -> np.ndarray:
        return np.add.reduceat(np.log10(self.root_arc), self.block.first)


ENCODED = "block bigint, doc_id array<bigint>, held_out array<boolean>, lengths binary, numbers binary, hashes binary, tokens bigint"


def blocks(docs: DataFrame, text: str, doc_id: str, modulus: int, most: int) -> DataFrame:
    """The texts as blocks of word numbers, each of some `most` characters of one task's rows; a longer text is one block."""
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.binary(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nr = TaskContext.get().partitionId() << 32
        ids: list = []
        held: list = []
        texts: list = []
        size = 0

        def block() -> pa.RecordBatch:
            lengths, numbers, hashes = encoded(texts)
            row = (nr, ids, held, packed(lengths), packed(numbers), hashes.tobytes(), len(numbers))
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                              [f.split()[0] for f in ENCODED.split(", ")])

        for batch in batches:
            for i, h, t in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), batch.column("text").to_pylist()):
                if texts and size + len(t or "") > most:
                    yield block()
                    nr, size, ids, held, texts = nr + 1, 0, [], [], []
                ids.append(i)
                held.append(h)
                texts.append(t)
                size += len(t or "")
        if texts:
            yield block()

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), held_out(doc_id, modulus).alias("held_out"),
                       F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, ENCODED)


def opened(batch: pa.RecordBatch | pa.Table, k: int) -> Block:
    lengths, numbers, hashes = (batch.column(c)[k].as_py() for c in ("lengths", "numbers", "hashes"))
    return Block(unpacked(lengths, "<u4"), unpacked(numbers, "<u4"), np.frombuffer(hashes, np.uint64))


QUESTIONS = [f"{what}{k}" for k in range(ORDERS) for what in ("keys", "own")]
TOTALS = [f"total{k}" for k in range(ORDERS)]


def asked(encoded_blocks: DataFrame, shards: int) -> DataFrame:
    """(shard, block, keys and own counts of each order): what a block asks a shard for, and adds to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block = opened(batch, k)
                own = list(block.own(~np.array(batch.column("held_out")[k].as_py(), bool)))
                borders = block.ranges(shards)
                parts = [(np.split(keys, b), np.split(c, b)) for keys, c, b in zip(block.keys, own, borders)]
                columns = [[packed(np.diff(p, prepend=np.uint64(0))) for p in keys] if what == "keys" else [*map(packed, counts)]
                           for keys, counts in parts for what in ("keys", "own")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(shards), pa.int64()), pa.array([batch.column("block")[k].as_py()] * shards, pa.int64()),
                     *(pa.array(c, pa.binary()) for c in columns)], ["shard", "block", *QUESTIONS])

    return encoded_blocks.select("block", "held_out", "lengths", "numbers", "hashes").mapInArrow(
        run, "shard bigint, block bigint, " + ", ".join(f"{c} binary" for c in QUESTIONS))


def answered(questions: DataFrame) -> DataFrame:
    """(block, shard, totals of each order), and one row without block for each shard: its tokens, distinct words and ends."""
    names = ["block", "shard", *TOTALS, "tokens", "words", "ends"]
    kinds = [pa.int64(), pa.int64(), *[pa.binary()] * ORDERS, *[pa.int64()] * 3]
    end = mixed(np.array([END_HASH], np.uint64))[0]

    def run(group: pa.Table) -> pa.Table:
        shard, asking = group.column("shard")[0].as_py(), group.column("block").to_pylist()
        replies, figures = [], None
        for k in range(ORDERS):
            keys = [np.cumsum(unpacked(x.as_py(), "<u8"), dtype=np.uint64) for x in group.column(f"keys{k}")]
            own = np.concatenate([unpacked(x.as_py(), "<u4") for x in group.column(f"own{k}")])
            distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(which, own, len(distinct)).astype(np.uint64)
            if k == 0:
                figures = int(total.sum()), int((total > 0).sum()), int(total[distinct == end].sum())
            replies.append([packed(t) for t in np.split(total[which], np.cumsum([len(x) for x in keys])[:-1])])
        rows = [(b, shard, *r, None, None, None) for b, *r in zip(asking, *replies)] + [(None, shard, *[None] * ORDERS, *figures)]
        return pa.table([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names)

    return questions.groupBy("shard").applyInArrow(
        run, "block bigint, shard bigint, " + ", ".join(f"{c} binary" for c in TOTALS) + ", tokens bigint, words bigint, ends bigint")


SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def scores(docs: DataFrame, modulus: int = 7, prior: float = PRIOR, text: str = "text", doc_id: str = "doc_id",
           block_size: int = BLOCK) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of docs.

    Training texts are those whose id isn't held out. A null or empty text is its end alone.
    Repeated rows are trained on as often as they occur and score alike; a null doc_id is
    trained on. Rows are blocked where they lie, so repeated rows or ids gather nowhere. A
    text is never cut: one longer than a block is a block of its own, held by one task.
    Without training texts every token is unknown. Hashes of pairs and triples have 48 bits:
    of n distinct ones a share of n / 2**48 gets another's count added; words have 64.
    Other columns are not read; an empty table gives no row.
    """
    kept = stored(blocks(docs, text, doc_id, modulus, block_size))
    size = kept.agg(F.sum("tokens")).first()[0] or 0
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(size * PER_TOKEN) // SHARD + 1)
    answers = stored(answered(asked(kept, shards)))
    known = answers.where("block IS NULL").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "words", "ends"))).first()
    tokens, words, texts = map(int, known)

    def run(group: pa.Table, totals: pa.Table) -> pa.Table:
        totals = totals.sort_by("shard")
        out = []
        for k in range(group.num_rows):  # one
            counts = [np.concatenate([unpacked(x.as_py(), "<u8") for x in totals.column(c)]) for c in TOTALS]
            auto = Automaton(opened(group, k), counts, tokens, words, texts, prior)
            known_tokens = np.add.reduceat((auto.count > 0).astype(np.int64), auto.block.first)
            n = len(known_tokens)
            out.append(pa.table([group.column("doc_id")[k].values, group.column("held_out")[k].values, pa.array(auto.block.lengths),
                                 pa.array(known_tokens), pa.array(np.full(n, tokens)), pa.array(auto.base()),
                                 pa.array(auto.traverse())], [f.split()[0] for f in SCORED.split(", ")]))
        return pa.concat_tables(out)

    replies = answers.where("block IS NOT NULL").select("block", "shard", *TOTALS)
    return kept.drop("tokens").groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, SCORED)
