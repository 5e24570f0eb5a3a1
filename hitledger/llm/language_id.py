"""Language ID by a byte convolutional network.

Texts are cut into windows of fixed length. Every byte has a vector; filters of
several widths slide over a window, each filter's greatest response is kept, and
a softmax over the languages rates them. The network is trained in numpy on the
driver from a bounded sample of labelled rows; inside tasks the first layer is a
table lookup for pairs of bytes, so that a window costs a few gathers a byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm.stages import adds, keeps
from hitledger.llm.textbytes import pieces, tidy

#: Bytes of a window.
WINDOW = 256
#: Labelled rows of each language that training takes; of a row it takes one window.
SAMPLE_ROWS = 2000
#: Steps that training takes at least, however few rows there are.
LEAST_STEPS = 200
WIDTHS = (2, 3, 4)
FILTERS, DEPTH = 16, 12


def symbols() -> np.ndarray:
    """Bytes as the network sees them: A-Z as a-z, one symbol each for blanks, digits, marks; other bytes are themselves."""
    table = np.zeros(256, np.int64)
    table[:128] = 2  # marks and controls
    table[[9, 10, 11, 12, 13, 32]] = 1
    table[48:58] = 3
    table[97:123] = np.arange(4, 30)
    table[65:91] = np.arange(4, 30)
    table[128:] = np.arange(30, 158)
    return table


N_SYMBOLS = 158  # 0 is the padding


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray                 # (N_SYMBOLS, DEPTH)
    filters: dict[int, np.ndarray]        # width -> (width * DEPTH, FILTERS)
    biases: dict[int, np.ndarray]
    dense: np.ndarray                     # (len(WIDTHS) * FILTERS, languages)
    offset: np.ndarray


def windows(data: np.ndarray, offsets: np.ndarray, length: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all rows as symbols (padded by 0), their rows, and their bytes."""
    sizes = np.diff(offsets)
    counts = -(-sizes // length)
    row = np.repeat(np.arange(len(sizes)), counts)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[row] + rank * length
    held = np.minimum(length, offsets[row + 1] - start)
    at = start[:, None] + np.arange(length)
    inside = np.arange(length) < held[:, None]
    own = symbols()[data[np.minimum(at, max(len(data) - 1, 0))]] if len(data) else np.zeros(at.shape, np.int64)
    return np.where(inside, own, 0), row, held


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def train(texts: list[bytes], labels: list[str], epochs: int = 6, seed: int = 5) -> Network:
    """A network from windows of labelled text (Adam, cross-entropy; languages count alike)."""
    languages = sorted(set(labels))
    target = np.array([languages.index(x) for x in labels])
    offsets = np.concatenate([[0], np.cumsum([len(t[:WINDOW]) for t in texts])])
    grid, rows, _ = windows(np.frombuffer(b"".join(t[:WINDOW] for t in texts), np.uint8), offsets)
    target = target[rows]
    share = np.bincount(target, minlength=len(languages))
    weight = (len(target) / (len(languages) * np.maximum(share, 1)))[target]
    rng = np.random.default_rng(seed)
    near = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    values = {"e": rng.normal(0, 1, (N_SYMBOLS, DEPTH)).astype(np.float32), "d": near(len(WIDTHS) * FILTERS, len(languages)), "o": np.zeros(len(languages), np.float32)}
    values["e"][0] = 0
    for w in WIDTHS:
        values[f"f{w}"], values[f"b{w}"] = near(w * DEPTH, FILTERS), np.zeros(FILTERS, np.float32)
    first = {k: np.zeros_like(v) for k, v in values.items()}
    second = {k: np.zeros_like(v) for k, v in values.items()}
    step = 0
    for _ in range(max(epochs, LEAST_STEPS // -(-len(grid) // 64))):
        order = rng.permutation(len(grid))
        for at in range(0, len(order), 64):
            own = order[at : at + 64]
            n, x = len(own), grid[order[at : at + 64]]
            emb = values["e"][x]
            kept, cache = [], {}
            for w in WIDTHS:
                span = WINDOW - w + 1
                view = np.concatenate([emb[:, k : k + span] for k in range(w)], axis=2)
                out = view.reshape(n * span, w * DEPTH) @ values[f"f{w}"]
                out = out.reshape(n, span, FILTERS)
                top = out.argmax(1)
                best = np.take_along_axis(out, top[:, None], 1)[:, 0] + values[f"b{w}"]
                kept.append(np.maximum(best, 0))
                cache[w] = (view, top, best > 0)
            hidden = np.concatenate(kept, 1)
            error = _softmax(hidden @ values["d"] + values["o"])
            error[np.arange(n), target[own]] -= 1
            error *= (weight[own] / n)[:, None]
            error = error.astype(np.float32)
            grads = {"d": hidden.T @ error, "o": error.sum(0), "e": np.zeros_like(values["e"])}
            back = error @ values["d"].T
            for i, w in enumerate(WIDTHS):
                view, top, live = cache[w]
                own_back = back[:, i * FILTERS : (i + 1) * FILTERS] * live
                grads[f"b{w}"] = own_back.sum(0)
                picked = view[np.arange(n)[:, None], top]             # (n, FILTERS, w * DEPTH)
                grads[f"f{w}"] = np.einsum("nfd,nf->df", picked, own_back)
                to_emb = (own_back[:, :, None] * values[f"f{w}"].T[None]).reshape(n, FILTERS, w, DEPTH)
                for k in range(w):
                    np.add.at(grads["e"], x[np.arange(n)[:, None], top + k], to_emb[:, :, k])
            grads["e"][0] = 0
            step += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                values[k] = values[k] - (0.004 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
    return Network(languages, values["e"], {w: values[f"f{w}"] for w in WIDTHS}, {w: values[f"b{w}"] for w in WIDTHS}, values["d"], values["o"])


class Lookup:
    """A network with its first layer as tables: the response of a filter part to each pair of symbols."""

    def __init__(self, net: Network):
        self.net = net
        self.parts: dict[int, list[tuple[int, np.ndarray]]] = {}
        for w, weights in net.filters.items():
            single = [net.embedding @ weights[k * DEPTH : (k + 1) * DEPTH] for k in range(w)]
            parts = []
            for k in range(0, w - 1, 2):
                pair = (single[k][:, None, :] + single[k + 1][None, :, :]).reshape(N_SYMBOLS * N_SYMBOLS, FILTERS)
                parts.append((k, np.ascontiguousarray(pair, np.float32)))
            if w % 2:
                parts.append((w - 1, np.ascontiguousarray(single[w - 1], np.float32)))
            self.parts[w] = parts

    def rate(self, grid: np.ndarray) -> np.ndarray:
        """Probabilities of the languages for each window."""
        out = []
        for at in range(0, len(grid), 64):
            x = grid[at : at + 64]
            pairs = x[:, :-1] * N_SYMBOLS + x[:, 1:]
            kept = []
            for w, parts in self.parts.items():
                span = x.shape[1] - w + 1
                total = None
                for k, table in parts:
                    rows = table[(pairs if len(table) > N_SYMBOLS else x)[:, k : k + span]]
                    total = rows if total is None else np.add(total, rows, out=total)
                kept.append(np.maximum(total.max(1) + self.net.biases[w], 0))
            out.append(_softmax(np.concatenate(kept, 1) @ self.net.dense + self.net.offset))
        return np.concatenate(out) if out else np.zeros((0, len(self.net.languages)))


def fit(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> Network | None:
    """A network from ``labelled`` (doc_id, text, lang), or None without labelled text.

    Of each language about ``rows`` rows are taken, those of the lowest hashes, and
    of each row one window at a hashed place; only these windows reach the driver.
    """
    full = labelled.where("lang is not null and trim(text) <> ''")
    shares = {r.lang: min(1.0, rows / r["count"]) for r in full.groupBy("lang").count().collect()}
    if not shares:
        return None
    share = F.create_map(*[F.lit(x) for pair in sorted(shares.items()) for x in pair])[F.col("lang")]
    draw = lambda salt: F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(salt)), 11) / F.lit(float(2**53))
    place = F.floor(draw(2) * F.greatest(F.length("text") - WINDOW // 2, F.lit(1))).cast("int") + 1
    sample = full.where(draw(1) < share).select("lang", F.substring("text", place, F.lit(WINDOW)).alias("text"))
    found = sorted((r.lang, r.text.encode("utf-8")) for r in sample.collect())
    found = [(lang, text) for lang, text in found if text.strip()]
    return train([t for _, t in found], [x for x, _ in found]) if found else None


@adds("lang_pred", "score")
def languages(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with lang_pred string and score double.

    ``docs`` needs text; nothing but text is looked at. A column of ``docs`` with one of these names gives way to it. All windows of a text are rated, and their probabilities
    averaged by the bytes they hold; score is the average of the language
    predicted. A text that is null or has no letter, and any text without a
    network, is ``und`` with score 0. Repeated rows get the same prediction.
    """
    if net is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    # As plain values: an instance would be looked up by its class's name, which workers may not know.
    shared = docs.sparkSession.sparkContext.broadcast(dict(vars(net)))
    names = docs.columns

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(Network(**shared.value))
        codes = np.array([*lookup.net.languages, "und"], object)
        for batch in batches:
            for part, data, offsets in pieces(batch, "text", 1 << 18):
                grid, row, held = windows(data, offsets)
                total = np.zeros((part.num_rows, len(codes) - 1))
                for at in range(0, len(row), 4096):
                    own = slice(at, at + 4096)
                    np.add.at(total, row[own], lookup.rate(grid[own]) * held[own, None])
                total /= np.maximum(np.diff(offsets), 1)[:, None]
                best = total.argmax(1)
                letters = np.array([_has_letter(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], bool)
                score = np.where(letters, np.clip(total[np.arange(len(best)), best], 0, 1), 0.0)
                lang = codes[np.where(letters, best, len(codes) - 1)]
                yield pa.record_batch(
                    [*(part.column(c) for c in names), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    names=[*names, "lang_pred", "score"],
                )

    schema = docs.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return docs.mapInArrow(tidy(docs.sparkSession, rows), schema)


def _has_letter(data: np.ndarray) -> bool:
    if ((data | 32) - 97 < 26).any():  # unsigned: below a wraps to large values
        return True
    return bool((data >= 128).any()) and any(map(str.isalpha, data.tobytes().decode("utf-8", "replace")))


def fold(doc_id: str) -> Column:
    """crc32 of the id's decimal text, modulo 4: rows with 2 are never learned from."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4))


@keeps("lang_pred", "score")
def keep_known(docs: DataFrame, net: Network | None, least: float = 0.4) -> DataFrame:
    """``docs`` without those of no language or of a score below ``least``; columns as they were."""
    return languages(docs, net).where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select(docs.columns)
