"""Preprocessing (M1-M6): type split, median / constant imputation,
standardisation with the population deviation, drop-first one-hot,
assembly.

The fitted preprocessor is a plain ``PipelineModel`` of a ``SQLTransformer``
(every step is a column expression with the fitted constants inlined) and a
``VectorAssembler``, so it is saved and loaded by Spark's own ML writer and
runs inside whole-stage codegen. Fitting takes three distributed passes
(exact medians, moments of the imputed values, category lists); only
per-column constants reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordered import exact_quantiles

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
MISSING = "missing"
MOST_CATEGORIES = 10_000


def split_types(df: DataFrame, features: list[str], id_col: str | None = None) -> tuple[list, list]:
    """M1: numeric and categorical (string) features, id dropped."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name not in features or f.name == id_col:
            continue
        if isinstance(f.dataType, NUMERIC):
            num.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            cat.append(f.name)
    order = {c: i for i, c in enumerate(features)}
    return sorted(num, key=order.get), sorted(cat, key=order.get)


def _num(c: str):
    x = F.col(c).cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def fit_medians(df: DataFrame, cols: list[str]) -> dict:
    """M2 fit: exact medians (mean of the two middle values), nulls/NaN
    ignored; an all-missing column gets 0."""
    if not cols:
        return {}
    long = df.select(*[_num(c).alias(c) for c in cols]).unpivot([], cols, "column", "value")
    q = exact_quantiles(long, "column", "value", [0.5]).collect()
    got = {r["column"]: r["q"] for r in q}
    return {c: float(got.get(c) if got.get(c) is not None else 0.0) for c in cols}


def fit_moments(df: DataFrame, cols: list[str], medians: dict) -> dict:
    """M4 fit: mean and population deviation of the imputed values;
    a zero deviation scales by 1."""
    if not cols:
        return {}
    imp = {c: F.coalesce(_num(c), F.lit(medians[c])) for c in cols}
    row = df.agg(*[F.avg(v).alias(f"m_{c}") for c, v in imp.items()],
                 *[F.stddev_pop(v).alias(f"s_{c}") for c, v in imp.items()]).first()
    out = {}
    for c in cols:
        s = row[f"s_{c}"]
        out[c] = (float(row[f"m_{c}"] or 0.0), float(s) if s else 1.0)
    return out


def fit_categories(df: DataFrame, cols: list[str]) -> dict:
    """M5 fit: sorted categories per column after constant imputation (M3).
    The one-hot output has a column for each of them; a column with more than
    ``MOST_CATEGORIES`` is no category and is refused."""
    out = {}
    for c in cols:
        vals = (df.select(F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias("v")).distinct()
                  .orderBy("v").limit(MOST_CATEGORIES + 1).collect())
        if len(vals) > MOST_CATEGORIES:
            raise ValueError(f"column {c} has more than {MOST_CATEGORIES} categories")
        out[c] = [r["v"] for r in vals]
    return out


def _lit(v: float) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass
class Preprocessor:
    """Fitted constants and the PipelineModel built from them."""
    numeric: list
    categorical: list
    medians: dict = field(default_factory=dict)
    moments: dict = field(default_factory=dict)
    categories: dict = field(default_factory=dict)
    scale: bool = True
    output: str = "features"

    @property
    def feature_names(self) -> list[str]:
        names = list(self.numeric)
        for c in self.categorical:
            names += [f"{c}={v}" for v in self.categories[c][1:]]
        return names

    def expressions(self) -> list[tuple[str, str]]:
        """(output column, SQL expression) per model feature."""
        out = []
        for i, c in enumerate(self.numeric):
            x = f"coalesce(nanvl(CAST({_q(c)} AS DOUBLE), CAST(NULL AS DOUBLE)), {_lit(self.medians[c])})"
            if self.scale:
                m, s = self.moments[c]
                x = f"(({x}) - {_lit(m)}) / {_lit(s)}"
            out.append((f"__f{i}", x))
        k = len(out)
        for c in self.categorical:
            filled = f"coalesce(CAST({_q(c)} AS STRING), {_str(MISSING)})"
            for v in self.categories[c][1:]:  # drop first; unknown -> all zeros
                out.append((f"__f{k}", f"CASE WHEN {filled} = {_str(v)} THEN 1.0D ELSE 0.0D END"))
                k += 1
        return out

    def model(self) -> PipelineModel:
        exprs = self.expressions()
        stmt = "SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in exprs) + " FROM __THIS__"
        sql = SQLTransformer(statement=stmt)
        asm = VectorAssembler(inputCols=[n for n, _ in exprs], outputCol=self.output, handleInvalid="keep")
        return PipelineModel(stages=[sql, asm])

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model().transform(df)
        return out.drop(*[n for n, _ in self.expressions()])


def fit_preprocessor(df: DataFrame, numeric: list[str], categorical: list[str], scale: bool = True,
                     output: str = "features") -> Preprocessor:
    """M2-M6 fit on ``df`` (the training rows)."""
    med = fit_medians(df, numeric)
    mom = fit_moments(df, numeric, med) if scale else {}
    cats = fit_categories(df, categorical)
    return Preprocessor(numeric, categorical, med, mom, cats, scale, output)


# Column-level forms used by the S-checked queries -------------------------

def impute_median(df: DataFrame, cols: list[str], medians: dict | None = None) -> DataFrame:
    medians = medians or fit_medians(df, cols)
    return df.withColumns({c: F.coalesce(_num(c), F.lit(medians[c])) for c in cols})


def impute_constant(df: DataFrame, cols: list[str], value: str = MISSING) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(value)) for c in cols})


def standardise(df: DataFrame, cols: list[str]) -> DataFrame:
    med = fit_medians(df, cols)
    mom = fit_moments(df, cols, med)
    return df.withColumns({c: (F.coalesce(_num(c), F.lit(med[c])) - mom[c][0]) / mom[c][1] for c in cols})


def one_hot(df: DataFrame, col: str, categories: list[str] | None = None, prefix: str | None = None) -> DataFrame:
    cats = categories or fit_categories(df, [col])[col]
    prefix = prefix or col
    filled = F.coalesce(F.col(col).cast("string"), F.lit(MISSING))
    return df.withColumns({f"{prefix}_{v}": F.when(filled == v, 1.0).otherwise(0.0) for v in cats[1:]})
