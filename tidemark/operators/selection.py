"""Drop variables that carry little or repeated information."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.scalars import nan_to_null
from tidemark.operators.comoments import correlation_matrix
from tidemark.operators.encode import apply_target_encoding, fit_target_encodings
from tidemark.operators.impute import fit_imputer
from tidemark.operators.profile import metadata_short

def variances(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Sample variance of each column, all in one pass."""
    row = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"v{i}"] for i, c in enumerate(columns)}


def low_variance(df: DataFrame, columns: list[str], minimum: float = 0.1) -> DataFrame:
    """(feature, variance, low) of each column."""
    found = variances(df, columns)
    rows = [(c, v, bool(v is not None and v < minimum)) for c, v in found.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, variance double, low boolean")


def correlations(df: DataFrame, columns: list[str]) -> list[list[float]]:
    """Pearson matrix; a pair uses the rows where both columns have a value.

    NaN where either is constant.  Only columns x columns numbers reach the driver.
    """
    clean = [nan_to_null(F.col(c).cast("double"), T.DoubleType()) for c in columns]
    return correlation_matrix(df, clean).tolist()


def correlated_pairs(df: DataFrame, columns: list[str], threshold: float = 0.5) -> DataFrame:
    """(feature, earlier, abs_r, above) for every pair of the upper triangle."""
    matrix = correlations(df, columns)
    rows = [
        (columns[j], columns[i], abs(matrix[i][j]), abs(matrix[i][j]) > threshold)
        for j in range(len(columns))
        for i in range(j)
    ]
    return df.sparkSession.createDataFrame(
        rows, "feature string, earlier string, abs_r double, above boolean"
    )


def correlated_features(df: DataFrame, columns: list[str], threshold: float = 0.5) -> list[str]:
    """Columns correlated above the threshold with any earlier column, dropped or not."""
    matrix = correlations(df, columns)
    return [columns[j] for j in range(len(columns)) if any(abs(matrix[i][j]) > threshold for i in range(j))]


@dataclass(frozen=True)
class Screened:
    """Prepared frame, names that were removed and the profile of the input."""

    frame: DataFrame
    dropped: list[str]
    profile: DataFrame


def screen_features(
    df: DataFrame,
    target: str,
    threshold: float = 0.5,
    max_null_pct: float = 70,
    min_variance: float | None = None,
    keep: list[str] | None = None,
) -> Screened:
    """Impute, target-encode and drop null-heavy, flat and correlated variables.

    All rows are used.  ``keep`` columns (keys) pass through untouched.
    """
    keep = keep or []
    features = [c for c in df.columns if c != target and c not in keep]
    profile = metadata_short(df.select(*features))
    order = {r["nome_variavel"]: r["percent_nulos"] for r in profile.collect()}
    usable = sorted((c for c in features if order[c] <= max_null_pct), key=lambda c: (-order[c], c))
    kinds = dict(df.dtypes)
    texts = [c for c in usable if kinds[c] in ("string", "boolean")]
    numbers = [c for c in usable if c not in texts]
    base = df.select(*keep, target, *numbers, *[F.col(c).cast("string").alias(c) for c in texts])
    filled = fit_imputer(base, "mean", numbers, texts).transform(base)
    for c, (table, mean) in fit_target_encodings(filled, texts, target).items():
        filled = apply_target_encoding(filled, c, table, mean)
    remaining, flat = numbers + texts, []
    if min_variance is not None:
        found = variances(filled, remaining)
        flat = [c for c in remaining if found[c] is not None and found[c] < min_variance]
        remaining = [c for c in remaining if c not in flat]
    close = correlated_features(filled, remaining, threshold) if len(remaining) > 1 else []
    kept = [c for c in remaining if c not in close]
    return Screened(filled.select(*keep, target, *kept), flat + close, profile)
