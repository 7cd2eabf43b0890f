"""Language identification by a byte convolutional network, trained in numpy on labelled text.

Texts are cut into windows of ``WINDOW`` bytes. Filters of several widths slide over a window; each
filter's largest response goes through a rectifier, then a linear layer and softmax. A text's prediction is
the softmax of its windows' mean logits, weighted by their bytes. A filter is a sum of table look-ups,
one for each of its bytes, so that inference adds rows of tables of byte pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SLICE_BYTES, fresh, release, set_aside, slices, table

WINDOW = 192
LETTER = regex.compile(r"\p{L}")


def folded(b: int) -> int:
    """Letters in lower case; digits, white space and other ASCII characters as one each."""
    if b > 127:
        return b
    c = chr(b)
    return ord(c.lower()) if c.isalpha() else ord("0") if c.isdigit() else ord(" ") if c in " \t\r\n\x0b\x0c" else ord(".")


FOLD = bytes(map(folded, range(256)))


@dataclass
class Network:
    classes: list[str]
    filters: list[np.ndarray]  # for each width: width x 256 x filters
    bias: np.ndarray
    weight: np.ndarray
    offset: np.ndarray

    def paired(self) -> list[list[tuple[int, np.ndarray]]]:
        """For each width: (first byte, table of 65,536 byte pairs or of 256 bytes)."""
        out = []
        for f in self.filters:
            parts = [(k, (f[k][:, None, :] + f[k + 1][None, :, :]).reshape(65536, -1)) for k in range(0, len(f) - 1, 2)]
            out.append(parts + ([(len(f) - 1, f[-1])] if len(f) % 2 else []))
        return out


def windows(data: bytes) -> np.ndarray:
    """Folded bytes in rows of ``WINDOW``, the last filled with zeros; one row of zeros for no bytes."""
    data = data.translate(FOLD)
    return np.frombuffer(data.ljust(max(1, -(-len(data) // WINDOW)) * WINDOW, b"\0"), "u1").reshape(-1, WINDOW)


def responses(x: np.ndarray, paired: list[list[tuple[int, np.ndarray]]], widths: list[int]) -> np.ndarray:
    """Each filter's largest response in each window."""
    pairs = (x[:, :-1].astype("i4") << 8) | x[:, 1:]
    out = []
    for parts, width in zip(paired, widths, strict=True):
        n, total = WINDOW - width + 1, None
        for k, t in parts:
            rows = np.take(t, (pairs if len(t) > 256 else x)[:, k : k + n], axis=0)
            total = rows if total is None else np.add(total, rows, out=total)
        out.append(total.max(axis=1))
    return np.concatenate(out, axis=1)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def sampled(data: bytes, per_text: int) -> np.ndarray:
    """``per_text`` windows drawn from all over a whole text (all if it has fewer); equal texts give equal windows."""
    w = windows(data)
    if len(w) <= per_text:
        return w
    return w[np.sort(np.random.default_rng(zlib.crc32(data)).choice(len(w), per_text, replace=False))]


def train(
    samples: list[tuple[bytes, str]],
    widths: tuple[int, ...] = (2, 3, 4),
    filters: int = 8,
    epochs: int = 5,
    batch: int = 64,
    rate: float = 0.01,
    seed: int = 5,
) -> Network:
    """Fit the network by Adam on windows: (folded bytes, a multiple of ``WINDOW``, and the language)."""
    rng = np.random.default_rng(seed)
    classes = sorted({lang for _, lang in samples})
    parts = [np.frombuffer(data, "u1").reshape(-1, WINDOW) for data, _ in samples]
    x = np.concatenate(parts)
    y = np.repeat([classes.index(lang) for _, lang in samples], [len(p) for p in parts])
    n_features, n_classes = filters * len(widths), len(classes)
    params = [rng.normal(0, 0.1, (w, 256, filters)).astype("f4") for w in widths]
    params += [np.zeros(n_features, "f4"), rng.normal(0, 0.3, (n_features, n_classes)).astype("f4")]
    params.append(np.zeros(n_classes, "f4"))
    moments, step = [(np.zeros_like(p), np.zeros_like(p)) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), batch):
            xb, yb = x[order[at : at + batch]], y[order[at : at + batch]]
            pooled, where = [], []
            for w, f in zip(widths, params, strict=False):
                n = WINDOW - w + 1
                conv = sum(np.take(f[k], xb[:, k : k + n], axis=0) for k in range(w))
                best = conv.argmax(axis=1)
                where.append(best)
                pooled.append(np.take_along_axis(conv, best[:, None], axis=1)[:, 0])
            z = np.concatenate(pooled, axis=1) + params[-3]
            h = np.maximum(z, 0)
            p = softmax(h @ params[-2] + params[-1])
            p[np.arange(len(yb)), yb] -= 1
            p /= len(yb)
            dz = (p @ params[-2].T) * (z > 0)
            grads = []
            for i, (w, best) in enumerate(zip(widths, where, strict=True)):
                g, d = np.zeros((w, 256 * filters), "f4"), dz[:, i * filters : (i + 1) * filters]
                for k in range(w):
                    cell = np.take_along_axis(xb, best + k, axis=1).astype("i8") * filters + np.arange(filters)
                    g[k] = np.bincount(cell.ravel(), d.ravel(), minlength=256 * filters)
                grads.append(g.reshape(w, 256, filters))
            grads += [dz.sum(axis=0), h.T @ p, p.sum(axis=0)]
            step += 1
            for q, g, (m, v) in zip(params, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(classes, [p.astype("f4") for p in params[:-3]], params[-3], params[-2], params[-1])


def predict(net: Network, batch: list[bytes], paired: list | None = None) -> tuple[list[str], list[float]]:
    """Most likely class and its probability for each whole text."""
    paired, widths = paired or net.paired(), [len(f) for f in net.filters]
    parts = [windows(b) for b in batch]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    x = np.concatenate(parts)
    size = (x != 0).sum(axis=1).astype("f8")
    total, weight = np.zeros((len(batch), len(net.classes))), np.bincount(owner, np.maximum(size, 1), len(batch))
    for at in range(0, len(x), 512):
        z = np.maximum(responses(x[at : at + 512], paired, widths) + net.bias, 0) @ net.weight + net.offset
        np.add.at(total, owner[at : at + 512], z * np.maximum(size[at : at + 512], 1)[:, None])
    p = softmax(total / weight[:, None])
    best = p.argmax(axis=1)
    return [net.classes[k] for k in best], p[np.arange(len(p)), best].tolist()


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_rows: int = 3000,
    per_text: int = 4,
    **options,
) -> Network | None:
    """A network from a bounded sample: of the rows with letters and label, the ``max_rows`` least by a hash of the id.

    Of each, ``per_text`` windows from all over its whole text: the driver gets at most max_rows * per_text windows.
    None if no row has a label.
    """
    labelled = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    # hashes below a bound that lets a fifth more than the sample through, so that few texts are windowed
    share = min(1.0, 1.2 * max_rows / max(1, labelled.count()))
    rows = labelled.select(
        F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("h"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    ).where(F.col("h") <= min(2**63 - 1, int(-(2**63) + share * 2.0**64)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [sampled(t.encode(), per_text).tobytes() if LETTER.search(t) else None for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["h"], part["lang"], pa.array(found, pa.binary())], ["h", "lang", "windows"])

    cells = rows.mapInArrow(cut, "h long, lang string, windows binary").where("windows IS NOT NULL")
    samples = [(bytes(r.windows), r.lang) for r in cells.orderBy("h", "lang", "windows").limit(max_rows).collect()]
    return train(samples, **options) if samples else None


def predictor(net: Network | None):
    """An Arrow function from texts to structs (lang, score); a batch goes by slices bounded in bytes."""

    @F.arrow_udf("struct<lang:string,score:double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()  # what other operators have left in this worker
        paired = net.paired() if net is not None else None
        for batch in batches:
            langs, scores = [], []
            whole = pa.RecordBatch.from_arrays([batch], ["text"])
            for part in slices(whole, "text", 512, SLICE_BYTES // 2):
                texts = part["text"].to_pylist()
                known = [net is not None and t is not None and LETTER.search(t) is not None for t in texts]
                data = [t.encode() for t, k in zip(texts, known, strict=True) if k]
                found = iter(zip(*predict(net, data, paired), strict=True)) if data else iter(())
                for k in known:
                    lang, score = next(found) if k else ("und", 0.0)
                    langs.append(lang)
                    scores.append(score)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])
        release()

    return run.asNondeterministic()


def identify(docs: DataFrame, net: Network | None, text_col: str = "text", lang_as: str = "lang_pred", score_as: str = "score") -> DataFrame:
    """``docs`` with a language and a score for every whole text; only the text goes to Python, once.

    Null texts, texts without letters, and all texts when there is no network: ``und`` with score 0. Repeated
    rows and null ids stay as they are; equal texts get equal results. No rows: no rows. A column of ``docs`` named like an output
    is kept with ``_input`` behind its name.
    """
    whole = set_aside(docs, [lang_as, score_as])
    text = F.col(whole.columns[docs.columns.index(text_col)]).cast("string")
    name = fresh(whole, "found")
    found = whole.withColumn(name, predictor(net)(text))
    return found.select(*whole.columns, F.col(name)["lang"].alias(lang_as), F.col(name)["score"].alias(score_as))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of the id as text, by 5, leaves 0. A null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents``: learnt from four fifths by the hash of doc_id, predicted for all."""
    docs = table(spark, sf_dir, "documents")
    net = fit(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text"), net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
