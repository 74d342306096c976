"""Batched providers with retries, write-back by key, resume and the quality gate."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.rank import global_rank

ERROR = "ERROR:"


class Provider(Protocol):
    """Loaded once a task; a batch call may fail, then its items are tried one by one."""

    def load(self) -> None: ...

    def batch(self, values: list) -> list: ...


class WordProvider:
    """A repeatable stand-in for a caption model: the ``n`` longest words; fails on texts that hold ``fail_on``."""

    def __init__(self, n: int = 3, fail_on: str | None = None):
        self.n, self.fail_on = n, fail_on

    def load(self) -> None:
        self.loaded = True

    def batch(self, values: list[str]) -> list[str]:
        if self.fail_on and any(self.fail_on in v for v in values):
            raise RuntimeError("rejected")
        return [", ".join(sorted(set(v.split()), key=lambda w: (-len(w), w))[: self.n]) for v in values]


PROVIDERS: dict[str, Callable[..., Provider]] = {"words": WordProvider}


def provider(name: str, **options) -> Provider:
    if name not in PROVIDERS:
        raise ValueError(f"unknown provider: {name}")
    return PROVIDERS[name](**options)


def attempt(call: Callable, value, retries: int, pause: float) -> tuple[object, str | None]:
    error = ""
    for turn in range(retries):
        try:
            return call([value])[0], None
        except Exception as e:  # a provider may fail in any way; the row carries why
            error = str(e)
            if turn + 1 < retries:
                time.sleep(pause)
    return None, error


def enrich(df: DataFrame, key: str, value: str, made: str, model: Provider, batch: int = 8, retries: int = 3, pause: float = 0.0) -> DataFrame:
    """``key, made, error`` for each row. The model is loaded once a task; a failed batch falls back to its items."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model.load()
        for frame in frames:
            values, results = frame[value].tolist(), []
            for at in range(0, len(values), batch):
                part = values[at : at + batch]
                try:
                    results += [(r, None) for r in model.batch(part)]
                except Exception:  # then each alone, with retries
                    results += [attempt(model.batch, v, retries, pause) for v in part]
            yield pd.DataFrame({key: frame[key], made: [r for r, _ in results], "error": [e for _, e in results]})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, value).where(F.col(value).isNotNull()).mapInPandas(run, f"{key} {kind}, {made} string, error string")


def write_back(rows: DataFrame, results: DataFrame, key: str, columns: list[str], success: Column) -> DataFrame:
    """Every row, with the results of those that succeeded and nulls for the rest."""
    return rows.join(results.where(success).select(key, *columns), key, "left")


def remaining(rows: DataFrame, done: DataFrame, key: str, retry_errors: bool = False, text: str | None = None) -> DataFrame:
    """Rows not yet completed; failed ones count as done unless they are to be tried again."""
    if retry_errors and text:
        done = done.where(~F.coalesce(F.col(text).startswith(ERROR), F.lit(False)))
    return rows.join(done.select(key).distinct(), key, "left_anti")


def quality_gate(df: DataFrame, path: str, text: str) -> DataFrame:
    """Keeps rows with a path and a text that is no error report."""
    return df.where(F.col(path).isNotNull() & F.col(text).isNotNull() & ~F.coalesce(F.col(text).startswith(ERROR), F.lit(False)))


def outcome(df: DataFrame, text: str) -> DataFrame:
    failed = F.count_if(F.col(text).startswith(ERROR))
    return df.agg(F.count(text).alias("total"), failed.alias("errors"), (F.count(text) - failed).alias("successful"))


def split_valid(df: DataFrame, test: Column) -> tuple[DataFrame, DataFrame]:
    tested = df.withColumn("ok", F.coalesce(test, F.lit(False)))
    return tested.where("ok").drop("ok"), tested.where(~F.col("ok")).drop("ok")


def triplets(df: DataFrame, degraded: str, original: str, text: str) -> DataFrame:
    """Input is the degraded image, output the original."""
    return df.select(F.col(degraded).alias("input_image"), F.trim(text).alias("instruction"), F.col(original).alias("output_image"))


def write_back_by_position(rows: DataFrame, results: DataFrame, row_order: Column, result_order: Column, columns: list[str]) -> DataFrame:
    """The i-th result beside the i-th row; rows past the last result get nulls. Both sides are numbered by range, so neither is sorted in one task."""
    numbered = global_rank(rows, row_order, name="__i")
    found = global_rank(results.select(*columns, result_order.alias("__by")), F.col("__by"), name="__i").drop("__by")
    return numbered.join(found, "__i", "left").drop("__i")
