"""Operator 1: language identification by averaged hashed subword embeddings and a linear softmax.

A text's subwords are the 1- to 4-grams of its lower-cased words with a blank before and behind, hashed into
buckets. The mean of their embeddings goes through one linear layer. Both are trained together by
stochastic gradient descent in numpy on a bounded sample; the layer is then folded into the embeddings, so that a prediction adds up
one row of language scores for each subword. Scores are probabilities after temperature scaling on
documents that were kept out of the training; below the threshold found there a prediction is rejected.

A softmax is sure of foreign text as well. So a prediction is also rejected if the text's subwords are not typical of the predicted language: the mean
logarithm of their frequency in it. The limit comes from documents kept out of the training, each judged once with its
language and once as if that had not been learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from weftloom.session import broadcast_if_small

SAMPLE_PER_LANGUAGE = 500  # labelled documents that are learned from, drawn by a hash of their id
BUCKETS = 1 << 16
DIMENSIONS = 16
EPOCHS = 6
LEARNING_RATE = 2.0
BATCH = 16
MISSED = 0.001  # share of right predictions that the rejection threshold may cost
FOREIGN = 0.05  # share of documents of an unlearned language that may pass as typical,
UNTYPICAL = 0.01  # unless more than this share of the learned ones would be lost
RARE = 1e-7  # frequency of a subword that a language doesn't have
UNKNOWN = "und"
_PIECE = 200_000  # characters handled at once
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], np.uint64)
_LETTERS: list[np.ndarray] = []


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    scores: np.ndarray  # bucket by language, the softmax layer's product with the embeddings
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    typical: np.ndarray | None = None  # bucket by language, logarithm of its frequency
    least_typical: float = -np.inf

    def probabilities(self, mean_scores: np.ndarray) -> np.ndarray:
        return softmax((mean_scores + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _is_letter() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def _pieces(texts: list[str | None], size: int) -> Iterator[list[tuple[int, str]]]:
    """Groups of (row, piece); long texts are cut where no letter is, so that no word is cut unless longer than ``size``."""
    group, held = [], 0
    for row, text in enumerate(texts):
        start = 0
        while text and start < len(text):
            end = min(len(text), start + size)
            if end < len(text):
                cut = end
                while cut > start and text[cut - 1].isalpha():
                    cut -= 1
                end = cut if cut > start else end
            if group and held + end - start > size:
                yield group
                group, held = [], 0
            group.append((row, text[start:end]))
            held += end - start
            start = end
    if group:
        yield group


def subwords(texts: list[str | None], size: int = _PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Yield (rows, buckets) of all subwords; rows ascend. Texts without letters have none."""
    letter = _is_letter()
    for group in _pieces(texts, size):
        lowered = [" " + piece.lower() for _, piece in group]
        code = np.frombuffer((" ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat(np.array([r for r, _ in group]), [len(x) + 1 for x in lowered])
        inside = letter[code]
        keep = inside.copy()  # words with the blanks beside them; those between texts are two, so subwords end there
        keep[1:] |= inside[:-1]
        keep[:-1] |= inside[1:]
        code, row, inside = np.where(inside, code, 32)[keep].astype(np.uint64), row[keep], inside[keep]
        if not len(code):
            continue
        total, rows, buckets = np.zeros(len(code), np.uint64), [], []
        for n in range(1, 5):
            if len(code) < n:
                break
            total = total[: len(code) - n + 1] + code[n - 1 :] * _MULTIPLIERS[n - 1]
            valid = inside[: len(total)] if n == 1 else np.ones(len(total), bool)
            for middle in range(1, n - 1):
                valid = valid & inside[middle : middle + len(total)]
            if n > 1:
                valid = valid & (inside[: len(total)] | inside[n - 1 : n - 1 + len(total)])
            rows.append(row[: len(total)][valid])
            buckets.append(((total[valid] + np.uint64(n)) * _MULTIPLIERS[0] >> np.uint64(64 - 16)).astype(np.int64) % BUCKETS)
        yield np.concatenate(rows), np.concatenate(buckets)


def _sum_rows(rows: np.ndarray, buckets: np.ndarray, table: np.ndarray, n: int) -> np.ndarray:
    """Sums of the table's rows at ``buckets`` by row; one column is gathered at a time, so that memory doesn't grow with their number."""
    return np.stack([np.bincount(rows, table[buckets, k], n) for k in range(table.shape[1])], axis=1)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct buckets of each text with their share of its subwords: bounded whatever the text's length."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        ids, weights = [], []
        for text in texts:
            count = np.zeros(BUCKETS, np.int64)
            for _, buckets in subwords([text]):
                count += np.bincount(buckets, minlength=BUCKETS)
            own = np.flatnonzero(count)
            ids.append(own.astype(np.int32))
            weights.append((count[own] / max(1, count.sum())).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("draw"), batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(weights, pa.list_(pa.float32()))],
            ["lang", "draw", "doc_id", "ids", "weights"],
        )


def held_out(doc_id: str = "doc_id"):
    """True for the fold that is never learned from; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, seed: int = 7) -> LanguageModel:
    """Learn from ``docs(doc_id, text, lang)``: texts and languages of rows with an id, outside the held-out fold.

    At most ``per_language`` documents of each language are used, those with the smallest hashes of their ids, so only these
    meet on the driver, as bounded bags of buckets. Without any labelled text, the model knows no language.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    counts = labelled.groupBy("lang").count()
    draw = F.xxhash64(F.lit(seed), "doc_id")
    # a little more than asked for is drawn by a hash threshold, so that texts are never shuffled
    share = F.lit(1.5 * per_language + 50) / F.col("count")
    bound = broadcast_if_small(counts)
    drawn = labelled.join(bound, "lang").where((draw / 2.0**64 + 0.5) < share).select("doc_id", "text", "lang", draw.alias("draw"))
    sample = drawn.mapInArrow(_features, "lang string, draw long, doc_id long, ids array<int>, weights array<float>")
    rows = sample.toArrow().combine_chunks()
    keys = zip(rows["lang"].to_pylist(), rows["draw"].to_pylist(), rows["doc_id"].to_pylist(), range(len(rows)))
    per, chosen = {}, []
    for language, _, _, at in sorted(keys):
        ids, weights = (rows[name][at].values.to_numpy() for name in ("ids", "weights"))  # views, as the sample is held once
        per[language] = per.get(language, 0) + 1
        if per[language] <= per_language and len(ids):
            chosen.append((language, ids, weights))
    return fit(chosen, seed)


def fit(bags: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> LanguageModel:
    """Stochastic gradient descent on (language, buckets, weights); every fifth bag is kept for the calibration."""
    languages = sorted({language for language, _, _ in bags})
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    draw = np.random.default_rng(seed)
    label = np.array([languages.index(language) for language, _, _ in bags])
    order = draw.permutation(len(bags))
    kept_out, used = order[: len(bags) // 5], order[len(bags) // 5 :]
    table = draw.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer, bias = np.zeros((DIMENSIONS, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    steps, step = EPOCHS * -(-len(used) // BATCH), 0
    for _ in range(EPOCHS):
        for batch in np.array_split(draw.permutation(used), -(-len(used) // BATCH)):
            rate = LEARNING_RATE * (1 - step / steps)
            step += 1
            ids = np.concatenate([bags[i][1] for i in batch])
            weights = np.concatenate([bags[i][2] for i in batch])[:, None]
            owner = np.repeat(np.arange(len(batch)), [len(bags[i][1]) for i in batch])
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            mean = np.add.reduceat(table[ids] * weights, starts)
            error = softmax(mean @ layer + bias)
            error[np.arange(len(batch)), label[batch]] -= 1
            error /= len(batch)
            back = error @ layer.T
            layer -= rate * (mean.T @ error)
            bias -= rate * 0.1 * error.sum(axis=0)
            # embeddings have tiny weights each, so they take the step for the sum of the batch
            np.subtract.at(table, ids, rate * len(batch) * weights * back[owner])
    share = np.zeros((BUCKETS, len(languages)))
    for i in used:
        share[bags[i][1], label[i]] += bags[i][2]
    typical = np.log(share / np.maximum(share.sum(axis=0), 1e-12) + RARE).astype(np.float32)
    model = LanguageModel(languages, (table @ layer).astype(np.float32), bias, typical=typical)
    return calibrate(model, [bags[i] for i in (kept_out if len(kept_out) else used)])


def calibrate(model: LanguageModel, bags: list[tuple[str, np.ndarray, np.ndarray]]) -> LanguageModel:
    """Temperature of least log loss, the threshold of the scores and the limit of what is typical.

    The threshold is the highest up to 1/2 that loses ``MISSED`` of the right predictions at most. The limit lets ``FOREIGN`` of the documents pass
    whose own language is left out, or loses ``UNTYPICAL`` of the learned ones, whichever is lower.
    """
    known = [bag for bag in bags if bag[0] in model.languages]
    if not known:
        return model
    mean = np.stack([(model.scores[ids] * weights[:, None]).sum(axis=0) for _, ids, weights in known]) + model.bias
    truth = np.array([model.languages.index(language) for language, _, _ in known])
    at = np.arange(len(truth))
    losses = {t: -np.log(softmax(mean / t)[at, truth] + 1e-12).mean() for t in np.geomspace(0.05, 5, 60)}
    temperature = float(min(losses, key=losses.get))
    chances = softmax(mean / temperature)
    right = np.sort(chances.max(axis=1)[chances.argmax(axis=1) == truth])
    threshold = float(min(0.5, right[int(MISSED * len(right))])) if len(right) else 0.0
    least = -np.inf
    if model.typical is not None:
        typical = np.stack([(model.typical[ids] * weights[:, None]).sum(axis=0) for _, ids, weights in known])
        least = float(np.quantile(typical[at, truth], UNTYPICAL))
        if len(model.languages) > 1:
            others = np.where(np.arange(len(model.languages)) == truth[:, None], -np.inf, mean)
            least = min(least, float(np.quantile(typical[at, others.argmax(axis=1)], 1 - FOREIGN)))
    return LanguageModel(model.languages, model.scores, model.bias, temperature, threshold, model.typical, least)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1) and ``accepted`` to the columns ``keep``, from the whole text alone.

    Accepted are predictions whose score reaches the model's threshold and whose text is as typical of the language as its limit asks.
    A text that is null, empty or without a letter gets ``und`` with score 0 and isn't accepted; so does any text if
    the model knows no language. Ties go to the first language by name. Repeated rows are treated alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*keep, *([] if text in keep else [F.col(text).alias("__text")]))
    at = source.columns.index(text if text in keep else "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        number = len(model.languages)
        size = min(_PIECE, max(10_000, 8_000_000 // max(1, number)))
        columns_of = model.scores if model.typical is None else np.concatenate([model.scores, model.typical], axis=1)
        for batch in batches:
            for start in range(0, len(batch), 1000):
                part = batch.slice(start, 1000)
                columns, texts = part.columns[: len(keep)], part.column(at)
                total, count = np.zeros((len(part), columns_of.shape[1])), np.zeros(len(part))
                for rows, buckets in subwords(texts.to_pylist(), size) if number else ():
                    # the rows of a piece are neighbours; only they are summed
                    low, n = int(rows.min(initial=len(part))), int(rows.max(initial=-1)) + 1
                    if n > low:
                        total[low:n] += _sum_rows(rows - low, buckets, columns_of, n - low)
                        count[low:n] += np.bincount(rows - low, minlength=n - low)
                known = count > 0
                language, score = np.full(len(part), UNKNOWN, object), np.zeros(len(part))
                accepted = np.zeros(len(part), bool)
                if known.any():
                    mean = total[known] / count[known, None]
                    chances = model.probabilities(mean[:, :number])
                    best = chances.argmax(axis=1)
                    language[known] = np.array(model.languages, object)[best]
                    score[known] = chances.max(axis=1)
                    accepted[known] = score[known] >= model.threshold
                    if model.typical is not None:
                        accepted[known] &= mean[np.arange(len(best)), number + best] >= model.least_typical
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(language, pa.string()), pa.array(score), pa.array(accepted)],
                    [*keep, "lang_pred", "score", "accepted"],
                )

    fields = [source.schema[name] for name in keep]
    added = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("accepted", T.BooleanType())]
    return source.mapInArrow(run, T.StructType([*fields, *(T.StructField(*x) for x in added)]))
