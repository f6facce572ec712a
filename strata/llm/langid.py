"""Language identification by hierarchical discrimination.

A text is first assigned to a language family, then one-versus-one linear
support vector machines vote between the languages of that family.  All
machines are linear in hashed counts of byte trigrams and quadgrams (ASCII
lower-cased), so the score of a whole text, however long, is a sum of table
look-ups over its positions and needs no feature vector.

Learning takes a bounded sample of labelled rows: at most ``sample`` texts in
all, the same number per language, drawn by a hash of the row.  The hash's threshold
has 64 bits and is raised while a language has too few rows below it, so no
labelled language is missing from the model, however many rows it has.  The model
(``dims`` x machines floats) is shipped to the tasks inside the function.

Defined cases: null text, or text without a letter: ``und``, score 0; nothing
to learn from: every text is ``und``; one language: that language, score 1; a
language that is in no family of the table is a family of its own; ties go to
the first label in code point order; repeated rows are predicted alike.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import packed, small_batches, unpacked

# Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "semitic": ("am", "ar", "he", "mt"),
    "sinitic": ("zh", "yue"),
}
UNDETERMINED = "und"
DIMS = 1 << 14
SAMPLE = 1200

LOWER = np.arange(256, dtype=np.uint32)
LOWER[65:91] += 32


def family_of(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang in langs), f"only {lang}")


def _grams(data: np.ndarray, dims: int) -> np.ndarray:
    """(2, n) feature numbers of the trigram and the quadgram that start at each
    position; positions past the end see zeros."""
    x = np.zeros(len(data) + 3, dtype=np.uint32)
    x[:len(data)] = LOWER[data]
    three = x[:-3] | (x[1:-2] << np.uint32(8)) | (x[2:-1] << np.uint32(16))
    four = three | (x[3:] << np.uint32(24))
    shift = np.uint32(32 - (dims.bit_length() - 1))
    return np.stack([(three * np.uint32(2654435761)) >> shift, (four * np.uint32(2246822519)) >> shift])


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow binary column and the n + 1 offsets (null: empty)."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def _count(dims: int):
    """The features of each text with unit length: numbers (uint16), then values (float16)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _texts(batch.column("body"))
            rows = []
            for a, b in zip(offsets[:-1], offsets[1:]):
                c = np.bincount(_grams(data[a:b], dims).ravel(), minlength=dims)
                ids = np.flatnonzero(c)
                values = c[ids] / np.sqrt((c[ids].astype(float) ** 2).sum()) if len(ids) else c[ids]
                rows.append(ids.astype(np.uint16).tobytes() + values.astype(np.float16).tobytes())
            yield pa.record_batch([batch.column("lang"), pa.array(rows, pa.binary())], ["lang", "x"])
    return run


Row = tuple[np.ndarray, np.ndarray]  # feature numbers and values of a text


def linear_svm(rows: list[Row], y: np.ndarray, dims: int, c: float = 4.0, epochs: int = 12, seed: int = 5) -> np.ndarray:
    """L2-regularised squared-hinge machine without bias, by dual coordinate descent."""
    rng = np.random.default_rng(seed)
    w = np.zeros(dims, np.float32)
    alpha = np.zeros(len(y))
    diag = np.array([float(v @ v) for _, v in rows]) + 1 / (2 * c)
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            ids, values = rows[i]
            g = y[i] * float(w[ids] @ values) - 1 + alpha[i] / (2 * c)
            new = max(0.0, alpha[i] - g / diag[i])
            if new != alpha[i]:
                w[ids] += np.float32((new - alpha[i]) * y[i]) * values
                alpha[i] = new
    return w


class Model:
    """Machines of the hierarchy: ``families`` one-versus-rest, ``pairs`` one-versus-one."""

    def __init__(self, rows: list[Row], langs: np.ndarray, dims: int):
        self.dims = dims
        self.langs = sorted(set(langs))
        self.families: dict[str, list[str]] = {}
        for lang in self.langs:
            self.families.setdefault(family_of(lang), []).append(lang)
        fam = np.array([family_of(v) for v in langs])
        columns = []
        if len(self.families) > 1:
            columns = [linear_svm(rows, np.where(fam == f, 1.0, -1.0), dims) for f in self.families]
        self.pairs = []
        for members in self.families.values():
            for i, a in enumerate(members):
                for b in members[i + 1:]:
                    own = np.flatnonzero((langs == a) | (langs == b))
                    self.pairs.append((a, b))
                    columns.append(linear_svm([rows[k] for k in own], np.where(langs[own] == a, 1.0, -1.0), dims))
        self.weights = np.stack(columns, axis=1) if columns else np.zeros((dims, 0), np.float32)

    def margins(self, data: np.ndarray, offsets: np.ndarray, step: int = 1 << 20) -> np.ndarray:
        """Mean margin per position of each text, (texts, machines)."""
        total = np.zeros((len(offsets) - 1, self.weights.shape[1]))
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            for lo in range(a, b, step):  # grams across a cut: read 3 bytes on
                hi = min(b, lo + step)
                ids = _grams(data[lo:min(b, hi + 3)], self.dims)[:, :hi - lo]
                hist = np.bincount(ids.ravel(), minlength=self.dims).astype(np.float32)
                total[i] += hist @ self.weights
        return total / np.maximum(offsets[1:] - offsets[:-1], 1)[:, None]

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(offsets) - 1
        if not self.langs:
            return [UNDETERMINED] * n, np.zeros(n)
        m = self.margins(data, offsets)
        nf = len(self.families) if len(self.families) > 1 else 0
        names = list(self.families)
        fam = m[:, :nf].argmax(axis=1) if nf else np.zeros(n, int)
        score = np.ones(n)
        if nf:
            best = np.sort(m[:, :nf], axis=1)
            score = _squash(best[:, -1] - best[:, -2])
        lang = np.array([self.families[names[f]][0] for f in fam], dtype=object)
        for f, name in enumerate(names):
            members = self.families[name]
            if len(members) == 1:
                continue
            votes = np.zeros((n, len(members)))
            edge = np.zeros((n, len(members)))
            for j, (a, b) in enumerate(self.pairs):
                if a not in members:
                    continue
                ia, ib, v = members.index(a), members.index(b), m[:, nf + j]
                votes[:, ia] += v >= 0
                votes[:, ib] += v < 0
                edge[:, ia] += v
                edge[:, ib] -= v
            rank = votes + np.tanh(edge) / 4  # margins only break ties of votes
            rows = fam == f
            lang[rows] = np.array(members, dtype=object)[rank.argmax(axis=1)][rows]
            score[rows] = np.minimum(score[rows], _squash(edge.max(axis=1) / (len(members) - 1))[rows])
        return list(lang), score


def _squash(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin * 400, -30, 30)))


def learn(labelled: DataFrame, sample: int = SAMPLE, dims: int = DIMS) -> Model:
    """Fit on ``labelled`` (row_id, body binary, lang; no nulls in body and lang)."""
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model([], np.array([]), dims)
    each = max(20, sample // len(counts))
    draw = F.xxhash64("row_id", "body", F.lit(11))
    share = {lang: 1.2 * each / n for lang, n in counts.items()}
    found, missing = [], counts
    while missing:
        keep = F.lit(False)
        for lang in missing:
            below = int(share[lang] * 2 ** 64) - 2 ** 63
            keep = keep | ((F.col("lang") == lang) & (F.lit(True) if share[lang] >= 1 else draw < below))
        drawn = labelled.filter(keep).withColumn(
            "_rank", F.row_number().over(Window.partitionBy("lang").orderBy(draw, "row_id")))
        rows = (drawn.filter(F.col("_rank") <= each).select("lang", "body")
                .mapInArrow(_count(dims), "lang string, x binary").collect())
        got = Counter(r["lang"] for r in rows)
        # rows repeated very often share a hash: too few others may lie below
        again = [lang for lang in missing if share[lang] < 1 and got[lang] < each / 2]
        found += [r for r in rows if r["lang"] not in again]
        share.update({lang: share[lang] * 16 for lang in again})
        missing = again
    if len({r["lang"] for r in found}) < len(counts):
        raise RuntimeError("a labelled language has no row in the sample")
    found.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    rows = []
    for r in found:
        n = len(r["x"]) // 4
        rows.append((np.frombuffer(r["x"], np.uint16, n).astype(np.int64),
                     np.frombuffer(r["x"], np.float16, n, 2 * n).astype(np.float32)))
    return Model(rows, np.array([r["lang"] for r in found], dtype=object), dims)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, train: Column, sample: int = SAMPLE, dims: int = DIMS, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` plus lang_pred and score; learns from rows where ``train`` holds and
    the language is not null.  Nothing but the text enters a prediction."""
    small_batches(docs.sparkSession)
    text = F.col(text_col)
    labelled = docs.filter(train & F.col(lang_col).isNotNull() & has_letter(text)).select(
        F.col(id_col).cast("string").alias("row_id"), F.col(lang_col).alias("lang"), text.cast("binary").alias("body"))
    model = learn(labelled, sample, dims)
    rows = packed(docs, _body=text.cast("binary"), _letters=has_letter(text))
    row_type = rows.schema["_row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                data, offsets = _texts(part.column("_body"))
                lang, score = model.predict(data, offsets)
                bare = ~np.asarray(part.column("_letters").to_numpy(zero_copy_only=False), dtype=bool)
                lang = [UNDETERMINED if b else v for b, v in zip(bare, lang)]
                yield pa.record_batch(
                    [part.column("_row"), pa.array(lang, pa.string()), pa.array(np.where(bare, 0.0, score))],
                    ["_row", "_lang_pred", "_score"])

    done = rows.mapInArrow(run, f"_row {row_type}, _lang_pred string, _score double")
    return unpacked(done, docs.columns, lang_pred=F.col("_lang_pred"), score=F.col("_score"))
