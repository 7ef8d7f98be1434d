"""Model scoring in batches; all other columns pass through."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsift.functions.image import model_pixels, resize_pixels, unpack_image
from crawlsift.functions.numeric import class_probability, cosine

#: Rows a model sees at once.
BATCH_SIZE = 20


def score(
    df: DataFrame,
    make_predict_fn: Callable[[], Callable],
    inputs: list[str],
    output: str = "prediction",
    return_type: T.DataType | None = None,
    batch_size: int = BATCH_SIZE,
    input_tensor_shapes=None,
    pad: bool = False,
) -> DataFrame:
    """Add ``output`` computed by a batch model.

    ``make_predict_fn`` loads the model once per Python worker and returns a function of numpy
    batches. With ``pad`` the inputs are variable-length integer arrays; each batch is
    zero-padded to its longest row. Every row is scored, the last short batch too.
    """
    kind = return_type or T.FloatType()
    if pad:
        predict = _padded_udf(make_predict_fn, kind, batch_size, len(inputs))
    else:
        predict = predict_batch_udf(
            make_predict_fn,
            return_type=kind,
            batch_size=batch_size,
            input_tensor_shapes=input_tensor_shapes,
        )
    # A threshold on the score must not be pushed below the model: it would run twice.
    predict = predict.asNondeterministic()
    return df.withColumn(output, predict(*[F.col(name) for name in inputs]))


def pad_rows(rows: list) -> np.ndarray:
    """Variable-length rows as one integer matrix, zero-padded on the right."""
    width = max((len(row) for row in rows), default=0)
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _padded_udf(make_predict_fn, kind: T.DataType, batch_size: int, n_inputs: int):
    def run(predict, columns: list[pd.Series]) -> pd.Series:
        results = []
        for at in range(0, len(columns[0]), batch_size):
            part = [
                pad_rows([() if row is None else row for row in c.iloc[at : at + batch_size]])
                for c in columns
            ]
            results.extend(np.asarray(predict(*part)))
        return pd.Series(results, dtype=object)

    if n_inputs == 1:

        @F.pandas_udf(kind)
        def padded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            predict = make_predict_fn()
            for batch in batches:
                yield run(predict, [batch])

    else:

        @F.pandas_udf(kind)
        def padded(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            predict = make_predict_fn()
            for batch in batches:
                yield run(predict, list(batch))

    return padded


def linear_token_model(weights: np.ndarray) -> Callable[[], Callable]:
    """Two-class model whose first logit sums one weight per unmasked token id.

    Closed form, so results can be checked in SQL; real models plug in the same way. Ids
    beyond the table weigh nothing.
    """
    table = np.asarray(weights, dtype=np.float64)

    def make() -> Callable:
        def predict(input_ids: np.ndarray, attention_mask: np.ndarray) -> np.ndarray:
            known = (input_ids >= 0) & (input_ids < len(table)) & (attention_mask > 0)
            first = np.where(known, table[np.where(known, input_ids, 0)], 0.0).sum(axis=1)
            return np.stack([first, np.zeros_like(first)], axis=1)

        return predict

    return make


def score_text(
    df: DataFrame,
    make_predict_fn: Callable[[], Callable],
    tokens: str = "tokens",
    output: str = "prediction",
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """Probability of class 0 from a model that gives logits for padded token batches."""
    flat = df.withColumn("_ids", F.col(f"{tokens}.input_ids")).withColumn(
        "_mask", F.col(f"{tokens}.attention_mask")
    )
    scored = score(
        flat,
        make_predict_fn,
        ["_ids", "_mask"],
        output="_logits",
        return_type=T.ArrayType(T.DoubleType()),
        batch_size=batch_size,
        pad=True,
    )
    return scored.withColumn(output, class_probability(F.col("_logits"), 0)).drop(
        "_ids", "_mask", "_logits"
    )


def mean_brightness_model(height: int, width: int, slope: float = 10.0) -> Callable[[], Callable]:
    """Closed-form image model: logistic of the mean pixel value around one half.

    The mean is taken in whole 8-bit steps, so resampling noise does not show in the score.
    """

    def make() -> Callable:
        def predict(pixels: np.ndarray) -> np.ndarray:
            mean = pixels.reshape(len(pixels), height * width * 3).astype(np.float64).mean(axis=1)
            mean = np.rint(mean * 765) / 765
            return 1.0 / (1.0 + np.exp(-slope * (mean - 0.5)))

        return predict

    return make


def score_image(
    df: DataFrame,
    make_predict_fn: Callable[[], Callable],
    height: int,
    width: int,
    resized: str = "resized",
    output: str = "prediction",
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """One probability per resized image."""
    return score(
        df,
        make_predict_fn,
        [resized],
        output=output,
        return_type=T.DoubleType(),
        batch_size=batch_size,
        input_tensor_shapes=[[height, width, 3]],
    )


def score_decoded(
    df: DataFrame,
    make_predict_fn: Callable[[], Callable],
    height: int,
    width: int,
    image: str = "image",
    output: str = "prediction",
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """``score_image`` straight from decoded images: resizing happens next to the model, so
    the resized pixels never travel back to the JVM. NULL images score NULL."""

    @F.pandas_udf(T.DoubleType())
    def resize_and_predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        predict = make_predict_fn()
        for frame in batches:
            out = np.full(len(frame), np.nan)
            present = np.flatnonzero(frame["data"].notna().to_numpy())
            for at in range(0, len(present), batch_size):
                rows = present[at : at + batch_size]
                pixels = [
                    resize_pixels(unpack_image(frame.iloc[i]), height, width) for i in rows
                ]
                out[rows] = np.asarray(predict(np.stack(pixels)), dtype=np.float64).reshape(-1)
            yield pd.Series(out).where(frame["data"].notna(), None)

    return df.withColumn(output, resize_and_predict.asNondeterministic()(F.col(image)))


def score_similarity(
    df: DataFrame,
    text_vector: str,
    image_vector: str,
    output: str = "prediction",
    scale: float = 100.0,
) -> DataFrame:
    """Scaled cosine of a text and an image embedding; rows that cannot be scored get 0."""
    logit = scale * cosine(F.col(text_vector), F.col(image_vector))
    return df.withColumn(output, F.coalesce(F.nanvl(logit, F.lit(0.0)), F.lit(0.0)))


def score_pairs(
    df: DataFrame,
    make_predict_fn: Callable[[], Callable],
    tokens: str = "tokens",
    image: str = "image",
    output: str = "prediction",
    size: int = 224,
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """Similarity logits of text-image pairs, in batches; a pair that fails scores 0.

    The model takes ids and masks, zero-padded to the longest row of the batch, and pixels
    (batch x 3 x ``size`` x ``size``), and gives a score per pair. Pixels are prepared next to
    the model and exist for one batch at a time. A batch that raises is repeated pair by pair,
    so one bad pair costs only its own score.
    """

    def score_rows(predict: Callable, ids: list, masks: list, pixels: list) -> list[float]:
        try:
            found = predict(pad_rows(ids), pad_rows(masks), np.stack(pixels))
            found = [float(x) for x in np.asarray(found).reshape(-1)]
            if len(found) != len(ids):
                raise ValueError(f"{len(found)} scores for {len(ids)} pairs")
            return found
        except Exception:  # whatever the model raises
            if len(ids) == 1:
                return [0.0]
            return [score_rows(predict, [i], [m], [p])[0] for i, m, p in zip(ids, masks, pixels)]

    @F.pandas_udf(T.DoubleType())
    def scored(batches: Iterator[tuple[pd.Series, pd.Series, pd.DataFrame]]) -> Iterator[pd.Series]:
        predict = make_predict_fn()
        for ids, masks, images in batches:
            rows = images.to_dict("records")
            out = np.zeros(len(rows))
            whole = [
                i for i, row in enumerate(rows) if row["data"] is not None and ids.iloc[i] is not None
            ]
            for at in range(0, len(whole), batch_size):
                part = whole[at : at + batch_size]
                pixels = [model_pixels(unpack_image(rows[i]), size) for i in part]
                out[part] = score_rows(predict, list(ids.iloc[part]), list(masks.iloc[part]), pixels)
            yield pd.Series(out)

    predict = scored.asNondeterministic()
    return df.withColumn(
        output,
        predict(F.col(f"{tokens}.input_ids"), F.col(f"{tokens}.attention_mask"), F.col(image)),
    )


def score_passthrough(df: DataFrame, output: str = "prediction") -> DataFrame:
    """Every row scores 1.0."""
    return df.withColumn(output, F.lit(1.0).cast("float"))
