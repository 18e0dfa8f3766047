"""Language-model scores from a probabilistic suffix tree over words.

The root holds add-one unigram probabilities. A context of k words, up to ORDER, is a candidate once it stands LEAST
times in the training texts, whatever their size, and the context without its first word is retained. It is retained if
its discounted next-word distribution gains GAIN nats or more over its parent's on the words that follow it. A retained
state's distribution is smoothed into its parent's by absolute discounting, which keeps it a proper distribution over
the vocabulary and the unknown word:

    P(w | s) = (c(s, w) - D if c(s, w) >= LEAST else 0) / c(s) + backoff(s) * P(w | parent(s))

A text is scored word by word, each in the state of the longest retained suffix of what stands before it; the end of a
text is a word too, and it also stands before the first word.

Counts, contexts and states grow with the corpus and are never broadcast. Texts are read once: they are stored as
blocks of word numbers. A block sends each bucket its distinct sorted keys with its own counts, and gets totals and
identifiers back in the same order, so a frequent word costs one entry a block. A sequence of k + 1 words is known by
the identifier of its first k and that of its last, so keys of all levels are two small numbers. Words are known by
64-bit hashes.

Nulls: a null text is empty and has one token, its end; a null doc_id hashes as the empty string and so is trained on.
Very long texts are a block of their own. Rows are scored one by one, so ties don't matter; repeated rows count and are
scored each time. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

#: Least times that a context, or a word after it, must be seen; discount; nats gained over the parent; words of context.
LEAST, DISCOUNT, GAIN, ORDER = 2, 0.75, 3.0, 4
BLOCK_BYTES, BUCKET_BYTES = 6 << 20, 16 << 20
END = np.uint64(0xA0761D6478BD642F)
#: An identifier is its bucket and its rank there; in the column of parents' probabilities, a context that isn't asked for.
RANK, UNASKED = 40, 65535
BLOCKS = "blk long, ids array<bigint>, held array<boolean>, counts binary, tokens binary, words array<struct<bucket: int, keys: binary, counts: binary>>"
ENTRY = "kind string, blk long, bucket int, keys binary, more binary, counts binary, parent binary"
ANSWER = "kind string, blk long, bucket int, keys binary, answer binary, n long, v long"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def coded(p: np.ndarray) -> np.ndarray:
    """Probabilities in steps of 1/1024 of a bit; they serve the divergence test alone."""
    return np.minimum(np.round(-1024 * np.log2(p)), UNASKED - 1).astype(np.uint16)


def decoded(q: np.ndarray) -> np.ndarray:
    return np.exp2(q.astype(np.float64) / -1024)


def arrow(rows: list, ddl: str) -> pa.Table:
    kinds = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "long": pa.int64()}
    fields = [x.split() for x in ddl.split(", ")]
    cols = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.table([pa.array(list(x), kinds[k]) for x, (_, k) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])


# ---- blocks ------------------------------------------------------------------------------------


def store_blocks(batches, buckets: int):
    """A row a block: its rows, its tokens as places in its sorted words, and the words with their training counts by bucket."""
    task = TaskContext.get().partitionId()
    for number, t in enumerate(c.gathered(batches, BLOCK_BYTES)):
        hs, counts = [], []
        for part in c.slices(t):
            flat, n = c.words(c.column(part, "text"), lower=True)
            (h,) = c.word_hashes(flat)
            hs.append(np.insert(h, np.cumsum(n), END))
            counts.append(n + 1)
        h, counts = np.concatenate(hs), np.concatenate(counts)
        held = c.column(t, "held").to_numpy(zero_copy_only=False).astype(bool)
        keys, at = np.unique(h, return_inverse=True)
        n = np.bincount(at[np.repeat(~held, counts)], minlength=len(keys)).astype(np.uint32)
        words = [{"bucket": i, "keys": c.pack_sorted(keys[x:y]), "counts": c.pack(n[x:y])} for i, x, y in c.cuts(c.bucket_of(keys, buckets), buckets)]
        kind = pa.list_(pa.struct([("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))
        yield pa.RecordBatch.from_arrays([
            pa.array([task << 32 | number], pa.int64()), pa.array([c.column(t, "doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([held.tolist()], pa.list_(pa.bool_())),
            pa.array([c.pack(counts.astype(np.uint32))], pa.binary()), pa.array([c.pack(at.astype(np.uint32))], pa.binary()), pa.array([words], kind),
        ], names=["blk", "ids", "held", "counts", "tokens", "words"])


def total_words(key, t: pa.Table, buckets: int) -> pa.Table:
    """Each block's words with their counts in all training texts and their ranks by count in the bucket; block -1 has the sums N and V."""
    blks, bucket = t.column("blk").to_pylist(), t.column("bucket")[0].as_py()
    keys = [c.unpack_sorted(x) for x in t.column("keys").to_pylist()]
    all_keys, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(all_keys), np.int64)
    np.add.at(total, at, np.concatenate([c.unpack(x, np.uint32) for x in t.column("counts").to_pylist()]).astype(np.int64))
    rank = np.empty(len(total), np.uint32)
    rank[np.argsort(-total, kind="stable")] = np.arange(len(total), dtype=np.uint32)
    rows, x = [("sum", -1, bucket, None, None, int(total.sum()), int((total > 0).sum()))], 0
    for b, k in zip(blks, keys, strict=True):
        own = at[x : x + len(k)]
        rows.append(("n0", b, bucket, None, packed(rank[own], total[own]), None, None))
        x += len(k)
    return arrow(rows, ANSWER)


def packed(*columns: np.ndarray) -> bytes:
    return pickle.dumps([c.pack(x) for x in columns])


def unpacked(data: bytes, *kinds) -> list[np.ndarray]:
    return [c.unpack(x, k) for x, k in zip(pickle.loads(data), kinds, strict=True)]


def distinct(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values in order, a place that has each, and which of them is at each place."""
    order = np.argsort(code)
    ordered = code[order]
    new = np.ones(len(code), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    which = np.empty(len(code), np.int32)
    which[order] = np.cumsum(new, dtype=np.int32) - 1
    start = np.flatnonzero(new)
    return ordered[start], order[start], which


def by_bucket(bucket: np.ndarray, n: int) -> np.ndarray:
    """A stable order by bucket; numbers of 16 bits are sorted by radix."""
    return np.argsort(bucket.astype(np.uint16) if n <= 1 << 16 else bucket, kind="stable")


def received(got: pa.Table, kind: str, *kinds) -> tuple[np.ndarray, ...]:
    """Answers of one kind, in the order of the keys sent: identifiers, or buckets where there are none, and the columns."""
    rows = sorted((b, k, a) for kd, b, k, a in zip(*(got.column(x).to_pylist() for x in ("kind", "bucket", "keys", "answer")), strict=True) if kd == kind)
    columns = [unpacked(a, *kinds) for _, _, a in rows]
    ids = [np.full(len(x[0]), b, np.int64) if k is None else c.unpack_sorted(k, np.int64) for (b, k, _), x in zip(rows, columns, strict=True)]
    cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return cat(ids, np.int64), *[cat([x[i] for x in columns], k) for i, k in enumerate(kinds)]


class Scorer:
    """The tokens of a block that are still in question, with what is known of them level by level as answers come in.

    At level k: `context`, the place of the k words before each token among `contexts`, -1 where they aren't known to be
    counted; `seen`, how often they stand in training; `low`, how often they do without their first word but with the
    token; `open`, whether the state of k words is in question; `send`, whether the token's pair is counted; `p`, the
    token's probability so far. What is settled goes into `sums`, by row of the block."""

    EACH = ("at", "doc", "word", "context", "seen", "low", "p", "first", "train", "open", "send")

    def __init__(self, block: pa.Table, got: pa.Table, n: int, v: int, order: int, buckets: int, least: int):
        self.order, self.buckets, self.least, self.level = order, buckets, least, 1
        self.ids, self.held = block.column("ids")[0].as_py(), block.column("held").combine_chunks().values.to_numpy(zero_copy_only=False).astype(bool)
        self.counts = c.unpack(block.column("counts")[0].as_py(), np.uint32).astype(np.int64)
        word = c.unpack(block.column("tokens")[0].as_py(), np.uint32).astype(np.int32)
        bucket, rank, total = received(got, "n0", np.uint32, np.int64)
        ids = bucket << RANK | rank.astype(np.int64)
        order_ = np.argsort(ids)  # places of words follow their identifiers from here on
        place = np.empty(len(ids), np.int32)
        place[order_] = np.arange(len(ids), dtype=np.int32)
        self.words, total, self.word = ids[order_], total[order_], place[word]
        self.at, rows = np.arange(len(word), dtype=np.int32), np.arange(len(self.counts), dtype=np.int32)
        start = np.cumsum(self.counts) - self.counts
        self.doc, self.train, self.first = np.repeat(rows, self.counts), np.repeat(~self.held, self.counts), np.zeros(len(word), bool)
        self.first[start] = True
        self.low, root = total[self.word], (total + 1.0) / (n + v + 1)
        self.p, self.sums = root[self.word], np.zeros(len(self.counts))
        self.base = np.add.reduceat(np.log10(root)[self.word], start) if len(start) else self.sums
        self.known = np.add.reduceat((total > 0).astype(np.int64)[self.word], start) if len(start) else self.counts
        # the word before; an end stands before each first word
        self.open = np.ones(len(word), bool)
        self.contexts, self.context = self.words, np.concatenate([self.word[-1:], self.word[:-1]])
        self.seen = total[self.context]
        self.settle()

    def placed(self) -> None:
        """What follows from the tokens' places: their rows, whether they are first there, and in training."""
        end = np.cumsum(self.counts)
        self.doc = np.searchsorted(end, self.at, "right").astype(np.int32)
        self.first = self.at == (end - self.counts)[self.doc]
        self.train = ~self.held[self.doc]

    def settle(self) -> None:
        """Close the tokens whose state has no candidate, and keep those that are asked for or counted.

        The last two levels leave out what no state can need; whether a pair is counted depends on its words alone, so
        all its occurrences are counted or none."""
        counted = (self.context >= 0) & (self.seen >= self.least)
        asked = self.open & counted
        self.close(np.flatnonzero(self.open & ~asked))
        self.open, send = asked, counted & (self.low >= self.least)
        if self.level >= self.order - 1:
            wanted = asked.copy()
            if self.level < self.order:
                wanted[:-1] |= asked[1:] & ~self.first[1:] & (np.diff(self.at) == 1)
            send &= wanted
        self.send = send
        keep = np.flatnonzero(asked | send)
        if len(keep) < 0.7 * len(send):
            for name in self.EACH:
                setattr(self, name, getattr(self, name)[keep])

    def close(self, tokens: np.ndarray) -> None:
        self.sums += np.bincount(self.doc[tokens], weights=np.log10(self.p[tokens]), minlength=len(self.counts))

    def sent(self):
        """The pairs in the order in which they are sent, by bucket and identifiers: (counted tokens, the pair of each, and of
        each pair its bucket, context and word as places, and a token that has it)."""
        at = np.flatnonzero(self.send)
        size = max(1, len(self.words))
        code, one, group = distinct(self.context[at].astype(np.int64) * size + self.word[at])
        u = code // size
        w = code - u * size
        a, b = self.contexts[u].astype(np.uint64), self.words[w].astype(np.uint64)
        bucket = c.bucket_of(c.mixed(a * np.uint64(0x9E3779B97F4A7C15) + c.mixed(b)), self.buckets)
        order = by_bucket(bucket, self.buckets)
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        return at, place[group], bucket[order], u[order], w[order], at[one[order]]

    def asks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens whose state is in question, the distinct contexts in order, and which each token has."""
        at = np.flatnonzero(self.open)
        used = np.zeros(len(self.contexts), bool)
        used[self.context[at]] = True
        return at, np.flatnonzero(used), (np.cumsum(used, dtype=np.int32) - 1)[self.context[at]]

    def absorb(self, got: pa.Table) -> "Scorer":
        """Take in the answers of this level, and go on to the next."""
        at, group, *_ = self.sent()
        asked, _, which = self.asks()
        ids, n = received(got, f"n{self.level}", np.int64)  # identifiers of those seen often enough to be contexts
        _, states, rest = received(got, f"state{self.level}", np.int64, np.int64)
        low = np.zeros(len(self.at), np.int64)
        low[at] = n[group] if len(at) else 0
        number, rest = (states[which], rest[which]) if len(asked) else (asked, asked)
        stay = number > 0
        kept, number, rest = asked[stay], number[stay], rest[stay]
        m = np.where(low[kept] >= self.least, low[kept] - DISCOUNT, 0)
        self.p[kept] = (m + (rest + DISCOUNT * number) * self.p[kept]) / self.seen[kept]
        ended = asked[~stay]
        self.close(ended)
        self.open[ended] = False
        # one word more before, under retained states only; nothing stands before a text's first word
        pair = np.full(len(self.at), -1, np.int32)
        pair[at] = group
        self.contexts = np.full(len(n), -1, np.int64)
        self.contexts[n >= self.least] = ids
        context, seen = np.full(len(self.at), -1, np.int32), np.zeros(len(self.at), np.int64)
        next_to = np.flatnonzero((np.diff(self.at) == 1) & ~self.first[1:])
        context[next_to + 1], seen[next_to + 1] = pair[next_to], low[next_to]
        context[seen < self.least] = -1
        self.context, self.seen, self.low = context, seen, low
        self.level += 1
        self.settle()
        return self

    def scores(self) -> np.ndarray:
        """Log10 probabilities by row, with open tokens as they are."""
        return self.sums + np.bincount(self.doc[self.open], weights=np.log10(self.p[self.open]), minlength=len(self.counts))

    def frozen(self) -> bytes:
        """The scorer as bytes, for the levels that are left."""
        words, word = np.unique(self.words[self.word], return_inverse=True)
        known = np.flatnonzero(self.context >= 0)
        used, one, which = distinct(self.context[known])  # few of the contexts are still in question
        context = np.full(len(self.at), -1, np.int32)
        context[known] = which
        rows = {"ids": self.ids, "held": self.held, "counts": c.pack(self.counts), "sums": self.sums, "base": self.base, "known": c.pack(self.known)}
        return pickle.dumps(rows | {
            "at": c.pack_sorted(self.at), "word": c.pack(word.astype(np.uint32)), "words": c.pack_sorted(words), "context": c.pack(context), "contexts": c.pack_sorted(self.contexts[used]), "seen": c.pack(self.seen[known][one]),
            "p": c.pack(self.p.astype(np.float32)), "open": np.packbits(self.open), "send": np.packbits(self.send), "level": self.level,
        })

    @classmethod
    def thawed(cls, block: pa.Table, order: int, buckets: int, least: int) -> "Scorer":
        self, x = cls.__new__(cls), pickle.loads(block.column("state")[0].as_py())
        self.order, self.buckets, self.least, self.level = order, buckets, least, x["level"]
        self.ids, self.held, self.sums, self.base = x["ids"], x["held"], x["sums"], x["base"]
        self.counts, self.known = c.unpack(x["counts"], np.int64), c.unpack(x["known"], np.int64)
        self.at, self.word, self.context = c.unpack_sorted(x["at"], np.int32), c.unpack(x["word"], np.uint32).astype(np.int32), c.unpack(x["context"], np.int32)
        self.words, self.contexts = c.unpack_sorted(x["words"], np.int64), c.unpack_sorted(x["contexts"], np.int64)
        self.seen = np.where(self.context >= 0, np.append(c.unpack(x["seen"], np.int64), 0)[self.context], 0)
        self.p = c.unpack(x["p"], np.float32).astype(np.float64)
        self.open, self.send = (np.unpackbits(x[k], count=len(self.at)).astype(bool) for k in ("open", "send"))
        self.low = np.zeros(len(self.at), np.int64)
        self.placed()
        return self


def emit_pairs(key, s: Scorer) -> pa.Table:
    blk, level, buckets, rows = key[0].as_py(), s.level, s.buckets, []
    at, group, bucket, u, w, one = s.sent()
    train = np.bincount(group[s.train[at]], minlength=len(u)).astype(np.uint32)
    p = np.where(s.open[one], coded(s.p[one]), UNASKED).astype(np.uint16)
    context, word = s.contexts[u], s.words[w]
    for i, x, y in c.cuts(bucket, buckets):
        rows.append((f"n{level}", blk, i, c.pack_sorted(context[x:y]), c.pack(word[x:y]), c.pack(train[x:y]), c.pack(p[x:y])))
    at, contexts, which = s.asks()
    seen = np.zeros(len(contexts), np.int64)
    seen[which] = s.seen[at]
    asked = s.contexts[contexts]
    for i, x, y in c.cuts(asked >> RANK, buckets):
        rows.append((f"ask{level}", blk, i, c.pack_sorted(asked[x:y]), None, c.pack(seen[x:y]), None))
    if level == s.order - 1:
        rows.append(("frozen", blk, -1, s.frozen(), None, None, None))
    return arrow(rows, ENTRY)


def total_pairs(key, t: pa.Table, level: int, buckets: int, least: int) -> pa.Table:
    """Totals of each block's pairs and identifiers of those seen often enough; and for each context, by its bucket, the
    parts of its sums over next words."""
    blks, bucket = t.column("blk").to_pylist(), t.column("bucket")[0].as_py()
    keys = [c.unpack_sorted(x, np.int64) for x in t.column("keys").to_pylist()]
    cat = lambda name, dtype: np.concatenate([c.unpack(x, dtype) for x in t.column(name).to_pylist()])
    u, w, n, p = np.concatenate(keys), cat("more", np.int64), cat("counts", np.uint32).astype(np.int64), cat("parent", np.uint16)
    contexts, _, cu = distinct(u)
    words, _, cw = distinct(w)
    _, one, rank = distinct(cu.astype(np.int64) * len(words) + cw)
    sums = np.bincount(rank, weights=n, minlength=len(one)).astype(np.int64)
    often = sums >= least
    ids = bucket << RANK | np.cumsum(often) - 1
    rows, x = [], 0
    for b, k in zip(blks, keys, strict=True):
        own = rank[x : x + len(k)]
        rows.append((f"n{level}", b, bucket, c.pack_sorted(ids[own[often[own]]]), packed(sums[own]), buckets, None))
        x += len(k)
    # parts of the contexts' sums: how many words follow, how often, and m log (m / parent's probability), m the discounted count
    use = often & (p[one] != UNASKED)
    n, m, one = sums[use], sums[use] - DISCOUNT, one[use]
    g = c.group_starts(u[one])
    contexts = u[one][g]
    if len(g):
        number, times = np.diff(np.append(g, len(one))), np.add.reduceat(n, g)
        gain = np.add.reduceat(m * np.log(m / decoded(p[one])), g).astype(np.float32)
        for i, x, y in c.cuts(contexts >> RANK, buckets):
            rows.append((f"part{level}", -2, i, c.pack_sorted(contexts[x:y]), packed(number[x:y], times[x:y], gain[x:y]), buckets, None))
    return arrow(rows, ANSWER)


def decide_states(key, t: pa.Table, level: int, gain: float) -> pa.Table:
    """For each state that a block asks for: how many words it has, 0 where it isn't retained, and how often others follow."""
    bucket, buckets = t.column("bucket")[0].as_py(), t.column("n")[0].as_py()
    rows = sorted(zip(*(t.column(x).to_pylist() for x in ("kind", "blk", "keys", "answer")), strict=True))
    parts = [(c.unpack_sorted(k, np.int64), *unpacked(a, np.int64, np.int64, np.float32)) for kind, _, k, a in rows if kind == f"part{level}"]
    asks = [(blk, c.unpack_sorted(k, np.int64), c.unpack(a, np.int64)) for kind, blk, k, a in rows if kind == f"ask{level}"]
    known, at = np.unique(np.concatenate([x for _, x, _ in asks]), return_inverse=True) if asks else (np.zeros(0, np.int64), np.zeros(0, int))
    seen = np.ones(len(known), np.int64)
    seen[at] = np.concatenate([x for _, _, x in asks]) if asks else 1
    number, times, won = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64), np.zeros(len(known))
    for u, k, n, w in parts:  # in a fixed order, so reruns agree
        at_u = np.searchsorted(known, u)
        np.add.at(number, at_u, k)
        np.add.at(times, at_u, n)
        np.add.at(won, at_u, w)
    mass = times - DISCOUNT * number
    back = np.where(number > 0, seen - mass, 1)
    number[won - mass * np.log(seen) + back * np.log(back / seen) < gain] = 0
    cut = np.cumsum([0, *(len(x) for _, x, _ in asks)])
    rest = seen - times
    return arrow(
        [(f"state{level}", blk, bucket, None, packed(number[at[x:y]], rest[at[x:y]]), buckets, None) for (blk, _, _), x, y in zip(asks, cut[:-1], cut[1:], strict=True)],
        ANSWER,
    )


def finish(s: Scorer, n: int) -> pa.Table:
    return pa.table({
        "doc_id": pa.array(s.ids, pa.int64()), "held_out": pa.array(s.held), "n_tokens": pa.array(s.counts), "n_known": pa.array(s.known),
        "train_tokens": pa.array(np.full(len(s.counts), n, np.int64)), "base_score": pa.array(s.base), "score": pa.array(s.scores()),
    })


def steps(n: int, v: int, order: int, level: int, buckets: int, least: int, gain: float):
    """The functions of one level: what a block sends, and what buckets of pairs and of states answer. The last levels start
    from frozen blocks, which have the answers up to theirs."""

    def scorer(block: pa.Table, got: pa.Table) -> Scorer:
        cold = "state" in block.column_names
        s = Scorer.thawed(block, order, buckets, least) if cold else Scorer(block, got, n, v, order, buckets, least)
        while s.level < level:
            s.absorb(got)
        return s

    return scorer, lambda k, d, g: emit_pairs(k, scorer(d, g)), lambda k, t: total_pairs(k, t, level, buckets, least), lambda k, t: decide_states(k, t, level, gain)


def score(spark: SparkSession, docs: DataFrame, held_out, order: int = ORDER, least: int = LEAST, gain: float = GAIN) -> DataFrame:
    """Scores of all texts by a tree learnt from those where `held_out`, a boolean Column, is false."""
    scratch, buckets = c.Scratch(spark, "suffix-tree"), max(16, c.text_bytes(docs) // BUCKET_BYTES)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held"))
    stored = scratch.put(docs.mapInArrow(lambda batches: store_blocks(batches, buckets), BLOCKS), "stored")
    words = stored.select("blk", F.inline("words"))
    got = scratch.put(words.groupBy("bucket").applyInArrow(lambda k, t: total_words(k, t, buckets), ANSWER), "words")
    sums = got.filter("blk = -1").agg(F.sum("n"), F.sum("v")).first()
    n, v = sums[0] or 0, sums[1] or 0
    got = got.filter("blk >= 0")
    blocks = scratch.put(stored.drop("words"), "blocks")
    scratch.drop("stored")
    for level in range(1, order + 1):
        _, ask, total, decide = steps(n, v, order, level, buckets, least, gain)
        sent = scratch.put(blocks.groupBy("blk").cogroup(got.groupBy("blk")).applyInArrow(ask, ENTRY), f"sent{level}")
        if level == order - 1:
            scratch.drop("blocks", "words", *[f"{x}{i}" for i in range(1, level) for x in ("pairs", "states")])
            blocks = scratch.put(sent.filter("kind = 'frozen'").select("blk", F.col("keys").alias("state")), "frozen")
        pairs = sent.filter(F.col("kind") == f"n{level}").groupBy("bucket").applyInArrow(total, ANSWER)
        pairs = scratch.put(pairs, f"pairs{level}")
        asks = (
            sent.filter(F.col("kind") == f"ask{level}")
            .select(
                "kind", "blk", "bucket", "keys", F.col("counts").alias("answer"), F.lit(buckets).cast("long").alias("n"),
                F.lit(None).cast("long").alias("v"),
            )
        )
        states = asks.unionByName(pairs.filter("blk < 0")).groupBy("bucket").applyInArrow(decide, ANSWER)
        new = pairs.filter("blk >= 0").unionByName(scratch.put(states, f"states{level}"))
        got = new if level == order - 1 else got.unionByName(new)
        scratch.drop(f"sent{level}")
    scorer, *_ = steps(n, v, order, order + 1, buckets, least, gain)
    return blocks.groupBy("blk").cogroup(got.groupBy("blk")).applyInArrow(lambda k, d, g: finish(scorer(d, g), n), RESULT)


def op2_suffix_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return score(spark, c.table(spark, sf_dir, "documents"), held)
