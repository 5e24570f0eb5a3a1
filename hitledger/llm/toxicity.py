"""Toxicity by a convolutional network over words.

A word is the sum of hashed vectors: one of the whole word, one for each of its
first 4 to 7 bytes, so that an unseen word resembles others that begin alike.
Filters of several widths slide over a text's words, each filter's greatest
responses in the whole text are kept (k-max pooling), and a logistic layer rates
them. Trained on all labelled rows, whole texts: tasks learn in numpy from their
rows, and what they moved is averaged after every round. A fifth of the rows is
kept apart and sets the scale of the score and each language's threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm.stages import Stages
from hitledger.llm.textbytes import pieces, span_sums, tidy, word_spans

#: Up to so many rows and bytes one task learns, in an order of its own; beyond, every task from its rows, in ROUNDS at most.
ALONE_ROWS, ALONE_BYTES, ROUNDS = 4000, 32 << 20, 4
#: Bytes of text whose words a task holds at once.
HELD_BYTES = 16 << 20
#: Buckets of a block in which tasks hand on what they counted or learned.
BLOCK = 512
#: Answers are counted by steps of 1 / STEP up to MOST on both sides.
STEP, MOST = 256, 20
#: Most languages with a threshold of their own: those with the most labelled rows.
LANGUAGES = 200
#: A bucket met in fewer labelled rows has the zero vector, and so has one never met.
LEAST_ROWS = 3
BUCKET_BITS = 17
BUCKETS, DEPTH = 1 << BUCKET_BITS, 12
WIDTHS, FILTERS, KEPT = (1, 2, 4), 12, 3
PREFIXES = (4, 5, 6, 7)
BATCH, BATCH_WORDS, RATE = 32, 1 << 17, 0.01
#: Passes over up to ALONE_ROWS rows, fewer over more, but not below the second; few rows are gone through until so many steps are made.
EPOCHS, LEAST_EPOCHS, LEAST_STEPS = 8, 2, 300

Model = dict


def _letters() -> np.ndarray:
    """A-Z as a-z; bytes of longer characters are themselves; all others are blanks."""
    table = np.full(256, 32, np.uint8)
    table[97:123] = table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


def word_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every word (n, features) and the first word of each row (rows + 1)."""
    clean = _letters()[data]
    if len(data):
        high = np.flatnonzero(data[:-1] == 0xC3) + 1  # Latin letters of two bytes: capitals as small ones
        high = high[(data[high] >= 0x80) & (data[high] <= 0x9E) & (data[high] != 0x97)]
        clean[high] += 0x20
    starts, ends, first = word_spans(clean, offsets)
    if not len(starts):
        return np.zeros((0, 1 + len(PREFIXES)), np.int64), first
    kinds = [span_sums(clean, starts, ends) * np.uint64(0x9E3779B97F4A7C15)]
    for k in PREFIXES:
        kinds.append((span_sums(clean, starts, np.minimum(starts + k, ends)) + np.uint64(k)) * np.uint64(0xBF58476D1CE4E5B9))
    return np.stack([(h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64) for h in kinds], 1), first


def _padded(first: np.ndarray) -> np.ndarray:
    """Where each row's words begin once every row is followed by blanks as long as the widest filter reaches."""
    return first + np.arange(len(first)) * (max(WIDTHS) - 1)


def _responses(vectors: np.ndarray, model: Model, w: int) -> np.ndarray:
    """Every filter of width ``w`` at every place of (padded) word vectors."""
    parts = vectors @ model[f"f{w}"]                      # (places, w * FILTERS)
    out = parts[:, :FILTERS].copy()
    for k in range(1, w):
        out[:-k] += parts[k:, k * FILTERS : (k + 1) * FILTERS]
    return out


def _pool(out: np.ndarray, begin: np.ndarray, sizes: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The KEPT greatest responses of each filter in each row, falling, and their places (-1: none)."""
    top = np.zeros((len(sizes), KEPT, FILTERS), np.float32)
    place = np.full(top.shape, -1, np.int64)
    for i, (at, n) in enumerate(zip(begin.tolist(), sizes.tolist())):
        if not n:
            continue
        own, k = out[at : at + n], min(n, KEPT)
        order = np.argpartition(own, n - k, axis=0)[n - k :] if n > k else np.broadcast_to(np.arange(n)[:, None], own.shape)
        values = np.take_along_axis(own, order, 0)
        rank = np.argsort(-values, axis=0, kind="stable")
        top[i, :k] = np.take_along_axis(values, rank, 0) + bias
        place[i, :k] = np.take_along_axis(order, rank, 0) + at
    live = (top > 0) & (place >= 0)
    return np.where(live, top, 0), np.where(live, place, -1)


def _forward(model: Model, features: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, dict]:
    sizes = np.diff(first)
    begin = _padded(first)
    vectors = np.zeros((int(begin[-1]) + 1, DEPTH), np.float32)
    at = np.arange(len(features)) + np.repeat(begin[:-1] - first[:-1], sizes)
    total = model["e"][features[:, 0]] if len(features) else np.zeros((0, DEPTH), np.float32)
    for k in range(1, features.shape[1]):
        total = total + model["e"][features[:, k]]
    vectors[at] = total
    kept, cache = [], {"vectors": vectors, "at": at}
    for w in WIDTHS:
        top, place = _pool(_responses(vectors, model, w), begin[:-1], sizes, model[f"b{w}"])
        kept.append(top.reshape(len(sizes), -1))
        cache[w] = place
    hidden = np.concatenate(kept, 1)
    cache["hidden"] = hidden
    return hidden @ model["d"] + model["o"], cache


def raw_scores(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The network's answer for every row, before it is brought to the scale of probabilities."""
    features, first = word_features(data, offsets)
    return _forward(model, features, first)[0].astype(np.float64)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets of words, first words and labels of rows (text, toxic), in runs of about HELD_BYTES of text."""
    found, sizes, labels, held = [], [], [], 0
    for batch in batches:
        for part, data, offsets in pieces(batch, "text"):
            features, first = word_features(data, offsets)
            found.append(features.astype(np.int32))
            sizes.append(np.diff(first))
            labels.append(part.column("toxic").to_numpy(zero_copy_only=False))
            held += len(data)
            if held >= HELD_BYTES:
                yield _whole(found, sizes, labels)
                found, sizes, labels, held = [], [], [], 0
    if found:
        yield _whole(found, sizes, labels)


def _whole(features: list, sizes: list, labels: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.concatenate(features), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), np.concatenate(labels).astype(np.float64)


def _blocks(values: np.ndarray, shard: int, rows: int) -> Iterator[pa.RecordBatch]:
    """What a task has for each bucket, as (block, shard, rows, own) without blocks that are all zero."""
    for block in range(0, len(values), BLOCK):
        own = values[block : block + BLOCK]
        if own.any():
            yield _block(block // BLOCK, shard, rows, own)


def _block(block: int, shard: int, rows: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([block], pa.int32()), pa.array([shard], pa.int32()), pa.array([rows], pa.int64()), pa.array([values.tobytes()], pa.binary())],
        names=["block", "shard", "rows", "own"],
    )


BLOCKS = "block int, shard int, rows long, own binary"


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """In how many ``rows`` (text, toxic) of label 0 and of label 1 each bucket is met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, n = np.zeros((BUCKETS, 2), np.int64), 0
        for features, bounds, labels in _held(batches):
            for a, b, y in zip(bounds[:-1], bounds[1:], labels):
                met[np.unique(features[a:b]), int(y)] += 1
            n += len(labels)
        yield from _blocks(met, TaskContext.get().partitionId(), n)

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(own, np.int64) for own in group.column("own").to_pylist())
        return pa.Table.from_batches([_block(group.column("block")[0].as_py(), 0, 0, total)])

    met = np.zeros((BUCKETS, 2), np.int64)
    for r in rows.mapInArrow(tidy(rows.sparkSession, count), BLOCKS).groupBy("block").applyInArrow(add, BLOCKS).collect():
        own = np.frombuffer(r.own, np.int64).reshape(-1, 2)
        met[r.block * BLOCK : r.block * BLOCK + len(own)] = own
    return met


def _begin(met: np.ndarray, labelled: tuple[int, int], seed: int) -> tuple[Model, np.ndarray]:
    """The network before training, and the buckets that count."""
    rng = np.random.default_rng(seed)
    near = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    model: Model = {"e": rng.normal(0, 0.1, (BUCKETS, DEPTH)).astype(np.float32)}
    for w in WIDTHS:
        model[f"f{w}"], model[f"b{w}"] = near(DEPTH, w * FILTERS), np.zeros(FILTERS, np.float32)
    model["d"], model["o"] = near(len(WIDTHS) * KEPT * FILTERS), np.zeros((), np.float32)
    known = met.sum(1) >= LEAST_ROWS
    # The first dimension begins as the log odds of a bucket, and all filters begin with a weight for it.
    odds = np.log((met[:, 1] + 0.5) / (labelled[1] + 1)) - np.log((met[:, 0] + 0.5) / (labelled[0] + 1))
    model["e"][:, 0] = np.clip(odds, -4, 4) / 4
    model["e"][~known] = 0
    for w in WIDTHS:
        model[f"f{w}"][0] = np.abs(model[f"f{w}"][0])
    model["d"] = np.abs(model["d"])
    return model, known


def _batches(order: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Rows in their order, BATCH at once, fewer where they have more than BATCH_WORDS words (a longer row alone)."""
    for begin in range(0, len(order), BATCH):
        own = order[begin : begin + BATCH]
        while len(own):
            n = max(1, int(np.searchsorted(np.cumsum(sizes[own]), BATCH_WORDS, "right")))
            yield own[:n]
            own = own[n:]


class Trainer:
    """Adam on cross-entropy for ``model``, which changes; ``weight`` of a row by its label."""

    def __init__(self, model: Model, known: np.ndarray, weight: tuple[float, float]):
        self.model, self.known, self.weight, self.step = model, known, np.array(weight), 0
        self.first = {k: np.zeros_like(v) for k, v in model.items()}
        self.second = {k: np.zeros_like(v) for k, v in model.items()}

    def learn(self, features: np.ndarray, bounds: np.ndarray, labels: np.ndarray, order: np.ndarray) -> None:
        model, first, second = self.model, self.first, self.second
        for own in _batches(order, np.diff(bounds)):
            x = np.concatenate([features[bounds[i] : bounds[i + 1]] for i in own])
            starts = np.concatenate([[0], np.cumsum(bounds[own + 1] - bounds[own])])
            answer, cache = _forward(model, x, starts)
            error = ((1 / (1 + np.exp(-answer)) - labels[own]) * self.weight[labels[own].astype(int)] / len(own)).astype(np.float32)
            grads = {"d": cache["hidden"].T @ error, "o": error.sum()}
            back = np.outer(error, model["d"]).reshape(len(own), len(WIDTHS), KEPT, FILTERS)
            to_vectors = np.zeros_like(cache["vectors"])
            for i, w in enumerate(WIDTHS):
                place = cache[w]
                row, kept, which = np.nonzero(place >= 0)
                at, amount = place[row, kept, which], back[row, i, kept, which]
                grads[f"b{w}"] = np.bincount(which, amount, FILTERS).astype(np.float32)
                grad = np.zeros_like(model[f"f{w}"])
                for k in range(w):
                    column = k * FILTERS + which
                    np.add.at(grad.T, column, cache["vectors"][at + k] * amount[:, None])
                    np.add.at(to_vectors, at + k, model[f"f{w}"].T[column] * amount[:, None])
                grads[f"f{w}"] = grad
            # Only the vectors of words that some filter kept move.
            moved = to_vectors[cache["at"]]
            hit, kind = np.nonzero(moved.any(1)[:, None] & self.known[x])
            buckets, inverse = np.unique(x[hit, kind], return_inverse=True)
            grad = np.zeros((len(buckets), DEPTH), np.float32)
            np.add.at(grad, inverse, moved[hit])
            self.step += 1
            slow, fast = 1 - 0.9**self.step, 1 - 0.999**self.step
            for k, g in [*grads.items(), ("e", grad)]:
                place = buckets if k == "e" else ...
                first[k][place] = 0.9 * first[k][place] + 0.1 * g
                second[k][place] = 0.999 * second[k][place] + 0.001 * g * g
                model[k][place] -= RATE * (first[k][place] / slow) / (np.sqrt(second[k][place] / fast) + 1e-6)


def _rest(model: Model) -> list[str]:
    return [k for k in model if k != "e"]


def _round(rows: DataFrame, model: Model, known: np.ndarray, weight: tuple[float, float], passes: int, seed: int) -> Model:
    """One round: every task learns from its ``rows`` (text, toxic); the mean of what they moved, weighted by rows, is added.

    A bucket's mean is over the tasks that moved it.
    """
    context = rows.sparkSession.sparkContext
    shared = context.broadcast((model, known))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old, counted = shared.value
        own, shard, n = {k: v.copy() for k, v in old.items()}, TaskContext.get().partitionId(), 0
        trainer, rng = Trainer(own, counted, weight), np.random.default_rng([seed, shard])
        for features, bounds, labels in _held(batches):
            for _ in range(passes):
                trainer.learn(features, bounds, labels, rng.permutation(len(labels)))
            n += len(labels)
        if n:
            yield from _blocks(own["e"] - old["e"], shard, n)
            yield _block(-1, shard, n, np.concatenate([np.ravel(own[k] - old[k]) for k in _rest(old)]))

    def mean(group: pa.Table) -> pa.Table:
        # Always added in one order, so that the same rows give the same sum.
        parts = sorted(zip(group.column("shard").to_pylist(), group.column("rows").to_pylist(), group.column("own").to_pylist()))
        block = group.column("block")[0].as_py()
        shape = (-1, DEPTH) if block >= 0 else (1, -1)
        total, rows = 0.0, 0.0
        for _, n, own in parts:
            delta = np.frombuffer(own, np.float32).reshape(shape).astype(np.float64)
            total, rows = total + n * delta, rows + n * (delta.any(1) | (block < 0))
        found = (total / np.maximum(rows, 1)[:, None]).astype(np.float32)
        return pa.Table.from_batches([_block(block, 0, 0, found)])

    moved = {r.block: np.frombuffer(r.own, np.float32) for r in rows.mapInArrow(tidy(rows.sparkSession, learn), BLOCKS).groupBy("block").applyInArrow(mean, BLOCKS).collect()}
    shared.destroy()
    new = {k: v.copy() for k, v in model.items()}
    rest, at = moved.pop(-1, None), 0
    for block, delta in moved.items():
        new["e"][block * BLOCK : (block + 1) * BLOCK] += delta.reshape(-1, DEPTH)
    for k in _rest(new) if rest is not None else ():
        new[k] = np.asarray(new[k] + rest[at : at + new[k].size].reshape(new[k].shape), np.float32)
        at += new[k].size
    return new


def train(rows: DataFrame, labelled: tuple[int, int], alone: bool, seed: int = 11) -> Model:
    """A network from ``rows`` (text, toxic), of which ``labelled`` have the labels 0 and 1; both labels count alike.

    ``alone``: all rows are in one partition.
    """
    n = sum(labelled)
    model, known = _begin(bucket_counts(rows), labelled, seed)
    weight = tuple(0.5 / max(1, x) * n for x in labelled)
    passes = max(LEAST_EPOCHS, min(EPOCHS, -(-EPOCHS * ALONE_ROWS // n)), -(-LEAST_STEPS // -(-n // BATCH)))
    rounds = 1 if alone else min(passes, ROUNDS)
    for i in range(rounds):
        model = _round(rows, model, known, weight, -(-passes // rounds), seed + i)
    return model


def _scale(answers: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn answers, each of so many rows, into probabilities (logistic regression, lightly drawn to slope 1)."""
    a, b = 1.0, 0.0
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(a * answers + b, -40, 40)))
        e, v = rows * (p - labels), rows * p * (1 - p)
        g = np.array([e @ answers + 0.1 * (a - 1), e.sum() + 0.01 * b])
        h = np.array([[v @ (answers * answers) + 0.1, v @ answers], [v @ answers, v.sum() + 0.01]])
        move = np.linalg.solve(h, g)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
    return float(a), float(b)


def _best_threshold(scores: np.ndarray, labels: np.ndarray, rows: np.ndarray | None = None) -> float | None:
    """Midway between the two scores (each of so many ``rows``, else one) where F1 is best; None unless both labels are there."""
    if len(set(labels.tolist())) < 2:
        return None
    order = np.argsort(-scores, kind="stable")
    n = np.ones(len(scores)) if rows is None else rows[order]
    s, y = scores[order], labels[order] * n
    hit = np.cumsum(y)
    f1 = 2 * hit / (np.cumsum(n) + y.sum())
    f1[:-1][s[:-1] == s[1:]] = 0  # no cut between equal scores
    k = int(f1.argmax())
    return float((s[k] + (s[k + 1] if k + 1 < len(s) else 0.0)) / 2)


def _answers(rows: DataFrame, model: Model) -> DataFrame:
    """(lang, step, toxic, rows): how often the network's answer, in steps, is met among ``rows`` (text, lang, toxic)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch, "text", 1 << 19):
                steps = np.rint(np.clip(raw_scores(shared.value, data, offsets), -MOST, MOST) * STEP).astype(np.int32)
                yield pa.record_batch([part.column("lang"), pa.array(steps), part.column("toxic")], names=["lang", "step", "toxic"])

    found = rows.select("text", "lang", "toxic").mapInArrow(tidy(rows.sparkSession, answer), "lang string, step int, toxic int")
    return found.groupBy("lang", "step", "toxic").agg(F.count(F.lit(1)).alias("rows"))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from ``docs`` (doc_id, text, lang) and ``labels`` (doc_id, toxic), None if not both labels occur.

    All labelled documents teach, with their whole texts; only counts and the network reach the driver.
    Null ids, texts and labels teach nothing; a document labelled more
    than once is toxic if any label says so. ``lang`` serves the thresholds only.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    if known.select("toxic").distinct().count() < 2:
        return None
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(5)), 11) / F.lit(float(2**53))
    texts = docs.select("doc_id", "text", "lang").where("doc_id is not null and text is not null")
    # By shuffle at any size: labels may be as many as documents.
    found = texts.join(known.hint("merge"), "doc_id").select("text", F.coalesce("lang", F.lit("")).alias("lang"), "toxic", (draw < 0.2).alias("apart"))
    stages = Stages(docs.sparkSession, "toxicity")
    rows = stages.write(found, "labelled")
    counts = rows.groupBy("apart", "toxic").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size")).collect()
    if len({r.toxic for r in counts}) < 2:
        stages.drop(rows)
        return None
    # Without both labels among the rows to learn from, none are kept apart; without both apart, the learned ones set the scale.
    own = len({r.toxic for r in counts if not r.apart}) == 2
    held = own and len({r.toxic for r in counts if r.apart}) == 2
    taught = [r for r in counts if not (own and r.apart)]
    labelled = tuple(sum(r.n for r in taught if r.toxic == y) for y in (0, 1))
    learned = rows.where("not apart") if own else rows
    alone = sum(labelled) <= ALONE_ROWS and sum(r.size for r in taught) <= ALONE_BYTES
    if alone:
        learned = learned.coalesce(1).sortWithinPartitions("text", "lang", "toxic")
    model = train(learned.select("text", "toxic"), labelled, alone)
    answers = stages.write(_answers(rows.where("apart") if held else learned, model), "answers")
    every = _by_answer(answers.groupBy("step", "toxic").agg(F.sum("rows").alias("rows")))
    model["scale"] = _scale(*every)
    overall = _best_threshold(_probability(model, every[0]), *every[1:])
    thresholds = {}
    most = [r.lang for r in answers.groupBy("lang").agg(F.sum("rows").alias("rows")).orderBy(F.desc("rows"), "lang").limit(LANGUAGES).collect()]
    for lang in most:
        answer, label, n = _by_answer(answers.where(F.col("lang") == lang))
        found = _best_threshold(_probability(model, answer), label, n)
        if found is not None:
            # Few rows say little of a language: its threshold is drawn to the overall one.
            few = min(int(n[label == 1].sum()), int(n[label == 0].sum()))
            thresholds[lang] = (few * found + 10 * overall) / (few + 10)
    model["thresholds"], model["threshold"] = thresholds, overall
    stages.drop(rows, answers)
    return model


def _by_answer(counted: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Answers, labels and numbers of rows of (step, toxic, rows)."""
    found = sorted((r.step, r.toxic, r.rows) for r in counted.select("step", "toxic", "rows").collect())
    step, toxic, rows = np.array(found, np.float64).reshape(-1, 3).T
    return step / STEP, toxic, rows


def _probability(model: Model, answers: np.ndarray) -> np.ndarray:
    a, b = model["scale"]
    return 1 / (1 + np.exp(-np.clip(a * answers + b, -40, 40)))


def toxicity(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score, threshold and toxic of every row of ``docs`` (doc_id, text, lang).

    ``score`` (0 to 1) comes from all words of the whole text and from nothing else; a null or empty text,
    and one without a letter, has the score of no words. ``threshold`` is the one of the row's ``lang`` (null: as empty;
    a language without one: the overall one), ``toxic`` whether the score reaches it. Without a model all scores are 0
    and nothing is toxic. Repeated rows get the same score; other columns are not looked at and not returned.
    """
    rows = docs.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("lang"))
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"), F.lit(1.0).alias("threshold"), F.lit(False).alias("toxic"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part, data, offsets in pieces(batch, "text", 1 << 19):
                found = _probability(own, raw_scores(own, data, offsets))
                least = np.array([own["thresholds"].get(x, own["threshold"]) for x in part.column(2).to_pylist()], np.float64)
                yield pa.record_batch(
                    [part.column(0), pa.array(found, pa.float64()), pa.array(least, pa.float64()), pa.array(found >= least)],
                    names=["doc_id", "score", "threshold", "toxic"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(rows.sparkSession, score), f"doc_id {kind}, score double, threshold double, toxic boolean")
