"""Row-wise feature derivation: specs and catalogues become one projection."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import all_pairs, collect_aggs, numeric_columns, q

EPSILON = 1e-6
CLASS_LIMIT = 10_000  # distinct labels an encoder may hold


def ratio(a: str | Column, b: str | Column, eps: float = EPSILON) -> Column:
    return _c(a) / (_c(b) + F.lit(eps))


def ratio_or_null(a: str | Column, b: str | Column, fill: float | None = None) -> Column:
    """``a / b`` with null for a zero divisor, optionally filled."""
    out = F.try_divide(_c(a), _c(b))
    return F.coalesce(out, F.lit(float(fill))) if fill is not None else out


def dissociated(a: str, ph: str, pk: float = 1.81) -> Column:
    return _c(a) / (1 + F.pow(F.lit(10.0), _c(ph) - F.lit(pk)))


def _c(x: str | Column) -> Column:
    return q(x) if isinstance(x, str) else x


# The derived columns a user of the wine workflow expects, by
# bundle. Each entry is (name, inputs, expression over those inputs).
BUNDLES: dict[str, list[tuple[str, tuple[str, ...], Callable[..., Column]]]] = {
    "ratios_and_logs": [
        ("sugar_acid_ratio", ("residual_sugar", "fixed_acidity"), ratio),
        ("sulfur_ratio", ("free_sulfur_dioxide", "total_sulfur_dioxide"), ratio),
        ("alcohol_density_ratio", ("alcohol", "density"), ratio),
        ("ph_sulphate_ratio", ("ph", "sulphates"), ratio),
        ("acid_ratio_2", ("citric_acid", "volatile_acidity"), ratio),
        ("log_residual_sugar", ("residual_sugar",), F.log1p),
        ("log_chlorides", ("chlorides",), F.log1p),
        ("log_sulphates", ("sulphates",), F.log1p),
        ("log_volatile_acidity", ("volatile_acidity",), F.log1p),
        ("log_citric_acid", ("citric_acid",), F.log1p),
    ],
    "acidity_and_body": [
        ("total_acidity", ("fixed_acidity", "volatile_acidity"), lambda a, b: _c(a) + _c(b)),
        ("sugar_acidity_ratio", ("residual_sugar", "fixed_acidity", "volatile_acidity"), lambda s, a, b: ratio(s, _c(a) + _c(b))),
        ("density_alcohol_ratio", ("density", "alcohol"), ratio),
        ("so2_ratio", ("free_sulfur_dioxide", "total_sulfur_dioxide"), ratio),
    ],
    "acid_balance": [
        ("total_acidity", ("fixed_acidity", "volatile_acidity"), lambda a, b: _c(a) + _c(b)),
        ("acidity_ratio", ("fixed_acidity", "volatile_acidity"), ratio),
        ("sugar_to_acid", ("residual_sugar", "fixed_acidity"), ratio),
        ("density_to_alcohol", ("density", "alcohol"), ratio),
    ],
    "expert": [
        ("total_acidity", ("fixed_acidity", "volatile_acidity"), lambda a, b: _c(a) + _c(b)),
        ("acidity_ratio", ("fixed_acidity", "volatile_acidity"), ratio),
        ("sugar_to_acidity", ("residual_sugar", "fixed_acidity", "volatile_acidity"), lambda s, a, b: ratio(s, _c(a) + _c(b))),
        ("alcohol_density", ("alcohol", "density"), lambda a, b: _c(a) * _c(b)),
    ],
    "sulfur": [
        ("total_acidity", ("fixed_acidity", "volatile_acidity"), lambda a, b: _c(a) + _c(b)),
        ("free_sulfur_ratio", ("free_sulfur_dioxide", "total_sulfur_dioxide"), lambda a, b: ratio(a, b, 1e-5)),
        ("alcohol_sugar_ratio", ("alcohol", "residual_sugar"), lambda a, b: ratio(a, b, 1e-5)),
        ("bound_sulfur_dioxide", ("total_sulfur_dioxide", "free_sulfur_dioxide"), lambda a, b: _c(a) - _c(b)),
    ],
    "merged": [
        ("total_acidity", ("fixed_acidity", "volatile_acidity"), lambda a, b: _c(a) + _c(b)),
        ("alcohol_density", ("alcohol", "density"), lambda a, b: ratio_or_null(a, b, 0.0)),
    ],
    "chemistry": [
        ("molecular_so2", ("free_sulfur_dioxide", "ph"), dissociated),
        ("acidity_ratio", ("fixed_acidity", "volatile_acidity"), lambda a, b: ratio(a, b, 1e-5)),
        ("body_index", ("alcohol", "residual_sugar"), lambda a, b: _c(a) * _c(b)),
        ("bound_so2", ("total_sulfur_dioxide", "free_sulfur_dioxide"), lambda a, b: _c(a) - _c(b)),
    ],
    "chemistry_shares": [
        ("molecular_so2", ("free_sulfur_dioxide", "ph"), dissociated),
        ("bound_so2", ("total_sulfur_dioxide", "free_sulfur_dioxide"), lambda a, b: _c(a) - _c(b)),
        ("total_acidity", ("fixed_acidity", "volatile_acidity"), lambda a, b: _c(a) + _c(b)),
        ("volatile_ratio", ("volatile_acidity", "fixed_acidity"), lambda v, f: ratio_or_null(v, _c(f) + _c(v), 0.0)),
        ("alcohol_density", ("alcohol", "density"), lambda a, b: _c(a) * _c(b)),
    ],
}


def bundle(df: DataFrame, name: str) -> DataFrame:
    """Add a bundle's columns; an entry whose inputs are missing is skipped."""
    return df.withColumns({
        out: make(*inputs) for out, inputs, make in BUNDLES[name] if all(i in df.columns for i in inputs)
    })


def derive(df: DataFrame, spec: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(spec))


def log_columns_fit(df: DataFrame, cols: list[str]) -> list[str]:
    """The columns whose training minimum is not negative."""
    low = collect_aggs(df, {c: F.min(q(c)) for c in cols})
    return [c for c in cols if low[c] is not None and low[c] >= 0]


def log_features(df: DataFrame, cols: list[str], mode: str = "add") -> DataFrame:
    """``add`` keeps the input beside ``log_c``; ``replace`` leaves only ``c_log``."""
    if mode == "add":
        return df.withColumns({f"log_{c}": F.log1p(q(c)) for c in cols})
    return df.withColumns({f"{c}_log": F.log1p(q(c)) for c in cols}).drop(*cols)


def pair_products(df: DataFrame, cols: list[str], eps: float = EPSILON) -> DataFrame:
    made = {}
    for a, b in all_pairs(cols):
        made[f"{a}_mul_{b}"] = q(a) * q(b)
        made[f"{a}_div_{b}"] = ratio(a, b, eps)
    return df.withColumns(made)


def poly2(df: DataFrame, cols: list[str], interaction_only: bool = False, prefix: str = "poly_") -> DataFrame:
    """Degree-two terms: squares (unless ``interaction_only``) and pair products."""
    made = {} if interaction_only else {f"{prefix}{c}_2": q(c) * q(c) for c in cols}
    made.update({f"{prefix}{a}_{b}": q(a) * q(b) for a, b in all_pairs(cols)})
    return df.withColumns(made)


def to_class(col: str | Column, lo: int, hi: int) -> Column:
    """Nearest integer (halves to even) inside the class range."""
    return F.least(F.greatest(F.rint(_c(col)), F.lit(float(lo))), F.lit(float(hi))).cast("int")


def label_fit(df: DataFrame, label: str) -> list:
    """Sorted distinct labels; the position is the code."""
    found = df.select(label).dropna().distinct().limit(CLASS_LIMIT + 1).collect()
    if len(found) > CLASS_LIMIT:
        raise ValueError(f"{label} has more than {CLASS_LIMIT} distinct values; index it with a join instead")
    return sorted(r[0] for r in found)


def encode_label(df: DataFrame, label: str, classes: list, out: str = "code") -> DataFrame:
    place = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label))
    return df.withColumn(out, F.when(place > 0, (place - 1).cast("int")))


def decode_label(df: DataFrame, code: str, classes: list, out: str = "label") -> DataFrame:
    return df.withColumn(out, F.try_element_at(F.array(*[F.lit(c) for c in classes]), (F.col(code) + 1).cast("int")))


def regression_to_proba(df: DataFrame, prediction: str, classes: list, alpha: float = 2.0) -> DataFrame:
    """Add ``p_<class>`` columns: softmax of ``-alpha * (prediction - class)²``.

    The largest exponent is taken off first, so a prediction far from every
    class cannot underflow to 0 / 0. The steps are columns of their own: written
    as one expression the shared terms would be repeated classes² times.
    """
    n = range(len(classes))
    power = {f"__e{i}": -F.lit(alpha) * F.pow(q(prediction) - F.lit(float(c)), F.lit(2)) for i, c in enumerate(classes)}
    top = F.greatest(*power) if len(classes) > 1 else F.col("__e0")
    out = df.withColumns(power).withColumn("__top", top)
    out = out.withColumns({f"__w{i}": F.exp(F.col(f"__e{i}") - F.col("__top")) for i in n})
    out = out.withColumn("__total", sum([F.col(f"__w{i}") for i in n[1:]], F.col("__w0")))
    out = out.withColumns({f"p_{c}": F.col(f"__w{i}") / F.col("__total") for i, c in enumerate(classes)})
    return out.drop("__top", "__total", *[f"__e{i}" for i in n], *[f"__w{i}" for i in n])


def feature_columns(df: DataFrame, target: str) -> list[str]:
    return numeric_columns(df, (target,))


def infinite_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN and ±infinity become null in the floating-point columns."""
    floats = cols or [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    inf = float("inf")
    return df.withColumns({c: F.when(F.isnan(q(c)) | q(c).isin(inf, -inf), None).otherwise(q(c)) for c in floats})
