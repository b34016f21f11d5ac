"""Log probability of texts under a unigram base and a small causal self-attention model.

Base: add-one counts of lower-cased words and text ends over all training documents. Words and their counts are keyed by
64-bit hashes. The FREQUENT most frequent words (a table of fixed size) are looked up where a text is read; all other words go through a
join, so that no count is left out and no vocabulary is sent whole.

Model: one layer of causal self-attention over subword ids, trained on all training documents. Their ids are dealt by hashes of their
texts over groups, whose number follows from the size of the texts alone, and ROUNDS. In a round every group starts from the weights sent
to it and takes a step on each batch of its windows; the changes of a weight row, in proportion to the ids that used it, are averaged
on Spark in the order of the groups, and only the averages, of the weights' size, come back. A corpus of fewer ids than STEPS batches is
read several times. Neither files, tasks nor cores change a score; it is rounded to PLACES_OF_SCORE. Rows that repeat train as often and get equal scores. An id is predicted as four digits, each a softmax over the state and a bias by the
digits before it. A text is read in windows of WINDOW ids that start every STRIDE ids; each id, and the end, is scored once, in
the window that sees most of what precedes it. Null texts are empty: their end alone is scored.
"""

from __future__ import annotations

import base64
import math
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispatchlens.llm.chunks import ChunkEncoder
from dispatchlens.llm.store import written

FREQUENT = 1 << 19
WINDOW, STRIDE = 32, 24
WIDTH = 16
DIGITS, BASE = 4, 15
STEPS, BATCH, RATE = 250, 64, 0.15
ROUNDS = 4
#: Ids in one row of the training table, and ids whose windows are mixed.
BLOCK, MIXED = 8_192, 64 * BATCH * WINDOW
#: Bytes of text for a group of all rounds, and groups at most; of a larger corpus each has more.
GROUP_BYTES, GROUPS_MOST = 32_000_000, 1_024
PLACES_OF_SCORE = 3
#: Weight rows summed together.
SUMMED = 4_096
END_WORD = xxhash.xxh3_64_intdigest(b" ")
ROUND = 256


@lru_cache(maxsize=1)
def _subwords(path: str) -> ChunkEncoder:
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("subwords", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return ChunkEncoder(lambda chunks: [np.array(encoding.encode_ordinary(c), "<u2").tobytes() for c in chunks])


def _ids(texts: list[str], path: str) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2") for x in _subwords(path).texts(texts)]


END_ID = 50256  # free in the vocabularies of 50,256 ids; also what stands before a text


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words of a text and of its end."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out[-1] = END_WORD
    return out


#: The shape of each weight; all but the biases are whole rows of WIDTH.
SHAPES = {"embed": (BASE ** DIGITS, WIDTH), "place": (WINDOW, WIDTH), "qkv": (WIDTH, 3 * WIDTH), "out": (WIDTH, WIDTH), "read": (WIDTH, DIGITS * BASE),
          **{f"bias{d}": (BASE ** d, BASE) for d in range(DIGITS)}}


def as_rows(weights: dict[str, np.ndarray]) -> np.ndarray:
    """All weights as one matrix of rows of WIDTH, in the order of SHAPES."""
    return np.concatenate([np.pad(weights[n], ((0, 0), (0, WIDTH - BASE))) if n.startswith("bias") else weights[n].reshape(-1, WIDTH) for n in SHAPES])


def from_rows(rows: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, (n, width) in SHAPES.items():
        size = n if name.startswith("bias") else n * width // WIDTH
        part = rows[at:at + size]
        out[name] = np.ascontiguousarray(part[:, :BASE] if name.startswith("bias") else part.reshape(n, width))
        at += size
    return out


def _summed(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different indices and the sum of each one's rows."""
    order = np.argsort(index, kind="stable")
    held = index[order]
    starts = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
    return held[starts], np.add.reduceat(values[order], starts, axis=0)


#: The digits of each id, and which columns of the digits' values belong together.
DIGITS_OF = np.stack([np.arange(BASE ** DIGITS) // BASE ** (DIGITS - 1 - d) % BASE for d in range(DIGITS)], 1)
GROUPS = np.repeat(np.eye(DIGITS, dtype=np.float32), BASE, axis=0)
PLACES = np.arange(DIGITS) * BASE


class Attention:
    """The model's weights and passes. Each weight is a float32 array in `w`."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights
        self.mask = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)

    @classmethod
    def started(cls, ids: np.ndarray) -> Attention:
        """Random states, and digit biases from the counts of the ids, so that training starts at the unigram model."""
        return cls.counted(np.bincount(ids, minlength=BASE ** DIGITS))

    @classmethod
    def counted(cls, counts: np.ndarray) -> Attention:
        rng = np.random.default_rng(0)
        def small(*shape):
            return (rng.standard_normal(shape) * 0.1).astype(np.float32)
        weights = {"embed": small(BASE ** DIGITS, WIDTH), "place": small(WINDOW, WIDTH), "qkv": small(WIDTH, 3 * WIDTH) * 2, "out": small(WIDTH, WIDTH), "read": small(WIDTH, DIGITS * BASE)}
        counts = counts.astype(np.float64) + 0.05
        for d in range(DIGITS):
            shares = counts.reshape(BASE ** d, BASE, -1).sum(2)
            weights[f"bias{d}"] = np.log(shares / shares.sum(1, keepdims=True)).astype(np.float32)
        return cls(weights)

    def states(self, before: np.ndarray):
        w = self.w
        x = w["embed"][before] + w["place"]
        q, k, v = np.split((x.reshape(-1, WIDTH) @ w["qkv"]).reshape(*x.shape[:2], 3 * WIDTH), 3, axis=2)
        seen = q @ k.transpose(0, 2, 1)
        seen *= 1 / math.sqrt(WIDTH)
        seen += self.mask
        np.exp(seen, out=seen)
        seen /= seen @ np.ones((WINDOW, 1), np.float32)
        met = seen @ v
        return x, q, k, v, seen, met, x + (met.reshape(-1, WIDTH) @ w["out"]).reshape(x.shape)

    def digits(self, state: np.ndarray, ids: np.ndarray):
        """Softmax of each digit, and the digits: state and ids are flat."""
        logits = state @ self.w["read"]
        own = DIGITS_OF[ids]
        for d in range(DIGITS):
            logits[:, d * BASE:(d + 1) * BASE] += self.w[f"bias{d}"][ids // BASE ** (DIGITS - d)] if d else self.w["bias0"]
        np.minimum(logits, 60, out=logits)  # biases start as log shares, so the largest is no need to be subtracted
        np.exp(logits, out=logits)
        p = logits.reshape(-1, DIGITS, BASE)
        p /= np.maximum(logits @ GROUPS, 1e-30)[:, :, None]
        return p, own

    def step(self, before: np.ndarray, ids: np.ndarray, memory: dict[str, np.ndarray]) -> float:
        """One Adagrad step on windows (before: ids that precede, ids: to predict); the mean loss."""
        w = self.w
        x, q, k, v, seen, met, state = self.states(before)
        flat, own = state.reshape(-1, WIDTH), ids.reshape(-1)
        p, digit = self.digits(flat, own)
        wide = p.reshape(len(own), -1)
        at = np.arange(len(own))[:, None] * wide.shape[1] + PLACES + digit
        picked = wide.reshape(-1)[at]
        wide.reshape(-1)[at] = picked - 1
        wide *= 1 / len(own)
        grads: dict[str, np.ndarray] = {}
        sparse = {f"bias{d}": _summed(own // BASE ** (DIGITS - d), p[:, d]) for d in range(DIGITS)}
        grads["read"] = flat.T @ wide
        g_state = (wide @ w["read"].T).reshape(state.shape)
        grads["out"] = met.reshape(-1, WIDTH).T @ g_state.reshape(-1, WIDTH)
        g_met = g_state @ w["out"].T
        g_seen = g_met @ v.transpose(0, 2, 1)
        g_v = seen.transpose(0, 2, 1) @ g_met
        g_seen = seen * (g_seen - (g_seen * seen).sum(2, keepdims=True)) / math.sqrt(WIDTH)
        g_qkv = np.concatenate([g_seen @ k, g_seen.transpose(0, 2, 1) @ q, g_v], 2)
        grads["qkv"] = x.reshape(-1, WIDTH).T @ g_qkv.reshape(-1, 3 * WIDTH)
        g_x = g_state + g_qkv @ w["qkv"].T
        grads["place"] = g_x.sum(0)
        sparse["embed"] = _summed(before.reshape(-1), g_x.reshape(-1, WIDTH))
        for name, g in grads.items():
            memory[name] += g * g
            w[name] -= RATE * g / (np.sqrt(memory[name]) + 1e-6)
        for name, (used, g) in sparse.items():
            held = memory[name][used] + g * g
            memory[name][used] = held
            w[name][used] -= RATE * g / (np.sqrt(held) + 1e-6)
        return float(-np.log(np.maximum(picked, 1e-30)).sum(1).mean())

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each text (subword ids), with its end."""
        befores, afters, froms, owners = [], [], [], []
        for k, ids in enumerate(texts):
            whole = np.concatenate([[END_ID], ids, [END_ID]]).astype(np.int64)
            n = len(whole) - 1
            starts = np.arange(0, max(1, n - (WINDOW - STRIDE)), STRIDE)
            at = starts[:, None] + np.arange(WINDOW)
            held = np.minimum(at, n - 1)
            befores.append(whole[held])
            afters.append(np.where(at < n, whole[held + 1], -1))
            first = np.full(len(starts), WINDOW - STRIDE)
            first[0] = 0
            froms.append(first)
            owners.append(np.full(len(starts), k))
        before, after, first, owner = map(np.concatenate, (befores, afters, froms, owners))
        out = np.zeros(len(texts))
        for at in range(0, len(before), ROUND):
            part = slice(at, at + ROUND)
            state = self.states(before[part])[-1]
            wanted = (after[part] >= 0) & (np.arange(WINDOW) >= first[part, None])
            ids = after[part][wanted]
            p, digit = self.digits(state[wanted], ids)
            total = p.reshape(-1)[np.arange(len(ids))[:, None] * (DIGITS * BASE) + PLACES + digit].astype(np.float64).prod(1)
            of = np.broadcast_to(owner[part][:, None], wanted.shape)[wanted]
            out += np.bincount(of, np.log10(np.maximum(total, 1e-300)), len(texts))
        return out


def _blocks(ids: np.ndarray) -> list[np.ndarray]:
    """The ids of a text and its end in blocks of BLOCK, each with the id before it in front."""
    whole = np.concatenate([[END_ID], ids, [END_ID]]).astype("<u2")
    return [whole[at:at + BLOCK + 1] for at in range(0, len(whole) - 1, BLOCK)]


def _batches(blocks):
    """(before, after) of BATCH windows at a time, mixed among MIXED ids; every id of the blocks is to predict at least once."""
    rng = np.random.default_rng(1)
    held, size = [], 0

    def windows(last):
        nonlocal held, size
        before, after = np.concatenate(held, axis=1)
        whole = len(before) // WINDOW * WINDOW
        rest, more = len(before) - whole, []
        if last and rest:  # the last window starts earlier; a stream under a window is repeated
            more = [(x[-WINDOW:] if len(x) >= WINDOW else np.resize(x, WINDOW))[None] for x in (before, after)]
        held, size = ([np.stack([before[whole:], after[whole:]])], rest) if rest and not last else ([], 0)
        pairs = [x[:whole].reshape(-1, WINDOW) for x in (before, after)]
        if more:
            pairs = [np.concatenate([x, y]) for x, y in zip(pairs, more, strict=True)]
        order = rng.permutation(len(pairs[0]))
        for at in range(0, len(order), BATCH):
            yield tuple(x[order[at:at + BATCH]].astype(np.int64) for x in pairs)

    for block in blocks:
        held.append(np.stack([block[:-1], block[1:]]))
        size += len(block) - 1
        if size >= MIXED:
            yield from windows(False)
    if size:
        yield from windows(True)


def _uses(ids: np.ndarray, before: np.ndarray) -> np.ndarray:
    """How many ids used each weight row: ids and before are counts by id."""
    n = float(ids.sum())
    of = {"embed": before, **{f"bias{d}": ids.reshape(BASE ** d, -1).sum(1) for d in range(DIGITS)}}
    return np.concatenate([of[k] if k in of else np.full(a * b // WIDTH, n) for k, (a, b) in SHAPES.items()])


def _memory(rows: np.ndarray) -> dict[str, np.ndarray]:
    return from_rows(np.repeat(rows[:, None], WIDTH, axis=1).astype(np.float32))


def fit(texts: list[str], path: str) -> tuple[Attention, list[float]]:
    """The model trained on texts by one task, and the loss of each step."""
    blocks = [b for x in _ids(texts, path) for b in _blocks(x)] or _blocks(np.empty(0, "<u2"))
    model = Attention.started(np.concatenate([b[1:] for b in blocks]).astype(np.int64))
    memory = {name: np.full_like(v, 1e-4) for name, v in model.w.items()}
    losses: list[float] = []
    while len(losses) < STEPS:
        losses += [model.step(*pair, memory) for pair in _batches(blocks)]
    return model, losses


def fitted(train: DataFrame, path: str) -> Attention:
    """The model trained on Spark over every id of the texts of train."""
    spark = train.sparkSession

    def encode(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                texts = batch.column(0).slice(at, 64).to_pylist()
                mixes, blocks = [], []
                for text, ids in zip(texts, _ids(texts, path), strict=True):
                    own = _blocks(ids)
                    name = text.encode("utf-8", "surrogatepass")
                    mixes += [xxhash.xxh3_64_intdigest(name, seed=k) - (1 << 63) for k in range(len(own))]
                    blocks += [b.tobytes() for b in own]
                yield pa.RecordBatch.from_pydict({"mix": pa.array(mixes, pa.int64()), "ids": pa.array(blocks, pa.binary())})

    def count(batches):
        total = np.zeros(BASE ** DIGITS, np.int64)
        for batch in batches:
            blocks = [np.frombuffer(x, "<u2")[1:] for x in batch.column(0).to_pylist()]
            total += np.bincount(np.concatenate(blocks), minlength=len(total)) if blocks else 0
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(used), "c": pa.array(total[used])})

    size = train.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    groups = min(max(1, -(-size // GROUP_BYTES)), GROUPS_MOST)
    # dealt by a hash of the text, so that no group or round has a single source, language or file
    dealt = train.select("text").mapInArrow(encode, "mix long, ids binary")
    dealt = dealt.select(F.pmod(F.xxhash64("mix"), F.lit(ROUNDS)).cast("int").alias("round"), F.pmod(F.xxhash64("mix", F.lit(1)), F.lit(groups)).cast("int").alias("group"), "mix", "ids")
    table = written(dealt, "ids")
    seen = table.select("ids").mapInArrow(count, "id long, c long").groupBy("id").agg(F.sum("c").alias("c")).toArrow()  # one row an id of the vocabulary
    counts = np.zeros(BASE ** DIGITS, np.int64)
    counts[seen["id"].to_numpy()] = seen["c"].to_numpy()
    n = int(counts.sum())
    model = Attention.counted(counts)
    if not n:
        return model
    passes = max(1, -(-STEPS * BATCH * WINDOW // n))
    rows, memory = as_rows(model.w), np.full(len(as_rows(model.w)), 1e-4)
    for r in range(ROUNDS):
        shared = spark.sparkContext.broadcast((rows, memory))
        dealt = table.where(F.col("round") == r).select("group", "mix", "ids").repartition("group").sortWithinPartitions("group", "mix", "ids")
        found = dealt.select("group", "ids").mapInArrow(_task(shared, passes), "part int, block int, data binary")
        found = found.repartition(-(-len(rows) // SUMMED), "block").sortWithinPartitions("block", "part").mapInArrow(_sums, "block int, data binary")
        rows, memory = rows.copy(), memory.copy()
        for block, data in zip(*found.toArrow().to_pydict().values(), strict=True):  # as many values as there are weights
            used, change = _unpacked(data)
            at = used + block * SUMMED
            rows[at] += (change[:, 2:] / change[:, :1]).astype(np.float32)
            memory[at] += change[:, 1] / change[:, 0]
        shared.unpersist()
    return Attention(from_rows(rows))


def _packed(used: np.ndarray, values: np.ndarray) -> bytes:
    return len(used).to_bytes(4, "little") + used.astype("<i4").tobytes() + values.astype("<f4").tobytes()


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    return np.frombuffer(data, "<i4", n, 4), np.frombuffer(data, "<f4", offset=4 + 4 * n).reshape(n, 2 + WIDTH).astype(np.float64)


def _task(shared, passes: int):
    """Local steps over each group's blocks; by blocks of weight rows: uses, growth of memory and change, both times uses."""
    def rows_of(batches):
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(1), strict=True)

    def run(batches):
        start, grown = shared.value
        for group, rows in groupby(rows_of(batches), key=lambda r: r[0]):
            model = Attention({k: v.copy() for k, v in from_rows(start).items()})
            memory = _memory(grown)
            ids, before = np.zeros(BASE ** DIGITS), np.zeros(BASE ** DIGITS)
            blocks = (np.frombuffer(x.as_py(), "<u2") for _, x in rows)
            blocks = list(blocks) * passes if passes > 1 else blocks  # repeated only when the whole corpus is small
            for first, then in _batches(blocks):
                model.step(first, then, memory)
                before += np.bincount(first.reshape(-1), minlength=len(before))
                ids += np.bincount(then.reshape(-1), minlength=len(ids))
            uses = _uses(ids, before)
            growth = as_rows(memory)
            growth[:, BASE:] = np.where(growth[:, BASE:] == 0, growth[:, :1], growth[:, BASE:])  # biases are one short of WIDTH
            values = np.column_stack([uses, (growth.mean(1) - grown) * uses, (as_rows(model.w) - start) * uses[:, None]])
            for block in range(-(-len(uses) // SUMMED)):
                own = values[block * SUMMED:(block + 1) * SUMMED]
                used = np.flatnonzero(own[:, 0])
                if len(used):
                    yield pa.RecordBatch.from_pydict({"part": pa.array([group], pa.int32()), "block": pa.array([block], pa.int32()), "data": pa.array([_packed(used, own[used])], pa.binary())})

    return run


def _sums(batches):
    """Sums of the tasks' values, a block at a time: rows come by block."""
    held, total = None, np.zeros((SUMMED, 2 + WIDTH))

    def flushed():
        used = np.flatnonzero(total[:, 0])
        return pa.RecordBatch.from_pydict({"block": pa.array([held], pa.int32()), "data": pa.array([_packed(used, total[used])], pa.binary())})

    for batch in batches:
        for block, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if held is not None and block != held:
                yield flushed()
                total[:] = 0
            held = block
            used, values = _unpacked(data)
            total[used] += values
    if held is not None:
        yield flushed()


def _counts(rows: DataFrame) -> DataFrame:
    """(word, c) over all tokens of the rows' texts."""
    def run(batches):
        held, size = [], 0

        def flush():
            words, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_pydict({"word": pa.array(words.view(np.int64)), "c": pa.array(n.astype(np.int64))})

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(word_hashes(text))
                size += len(held[-1])
                if size > 4_000_000:  # 32 MB; what Spark adds up after
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return rows.select("text").mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def scored(docs: DataFrame, held_out, path: str) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row; held_out is a column over doc_id."""
    spark = docs.sparkSession
    rows = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    train = rows.where(~F.col("held_out"))
    counts = written(_counts(train), "counts")
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = totals["n"], totals["v"]
    top = counts.orderBy(F.desc("c"), "word").limit(FREQUENT).toArrow().sort_by("word")  # FREQUENT rows of 16 bytes
    model = fitted(train, path)
    shared = spark.sparkContext.broadcast((top["word"].to_numpy(), top["c"].to_numpy(), model.w))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        words, c, weights = shared.value
        attention = Attention(weights)
        logs = np.log10(c + 1.0)
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = part.column(1).to_pylist()
                hashes = [word_hashes(t).view(np.int64) for t in texts]
                sizes = np.array([len(h) for h in hashes])
                owner = np.repeat(np.arange(len(texts)), sizes)
                flat = np.concatenate(hashes)
                place = np.searchsorted(words, flat)
                found = words[np.minimum(place, len(words) - 1)] == flat if len(words) else np.zeros(len(flat), bool)
                known = np.bincount(owner[found], minlength=len(texts))
                base = np.bincount(owner[found], logs[place[found]], len(texts))
                others, times = np.unique(np.stack([owner[~found], flat[~found]]), axis=1, return_counts=True) if not found.all() else (np.empty((2, 0), np.int64), np.empty(0, np.int64))
                m = others.shape[1]
                ids = np.arange(row, row + len(texts))
                row += len(texts)
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array(np.concatenate([ids, ids[others[0]]])), "doc_id": pa.concat_arrays([part.column(0), pa.nulls(m, part.column(0).type)]),
                    "held_out": pa.concat_arrays([part.column(2), pa.nulls(m, pa.bool_())]), "word": pa.concat_arrays([pa.nulls(len(texts), pa.int64()), pa.array(others[1])]),
                    "n": pa.array(np.concatenate([sizes, times])), "known": pa.concat_arrays([pa.array(known), pa.nulls(m, pa.int64())]),
                    "base": pa.concat_arrays([pa.array(base, pa.float64()), pa.nulls(m, pa.float64())]), "score": pa.concat_arrays([pa.array(attention.scores(_ids(texts, path)), pa.float64()), pa.nulls(m, pa.float64())])})

    schema = f"row long, doc_id {kind}, held_out boolean, word long, n long, known long, base double, score double"
    all_rows = written(rows.select("doc_id", "text", "held_out").mapInArrow(run, schema), "scored")
    rest = all_rows.where("word is not null").select("row", F.col("word").alias("_word"), "n")
    rest = rest.join(counts, F.col("_word") == F.col("word")).groupBy(F.col("row").alias("_row")).agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("more_base"))
    own = all_rows.where("word is null").join(rest, F.col("row") == F.col("_row"), "left")
    size = math.log10(n + v + 1)
    return own.select("doc_id", "held_out", F.col("n").alias("n_tokens"), (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
                      (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n") * F.lit(size)).alias("base_score"), F.round("score", PLACES_OF_SCORE).alias("score"))
