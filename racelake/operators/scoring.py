"""Feature vectors and logistic scores."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import ROUND_HALF_EVEN, Context, Decimal, localcontext

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .checks import count_where, gate


def vocabulary_index(value: Column, vocabulary: Sequence[str]) -> Column:
    """The place of a value in the vocabulary; entry 0 stands for the unknown. A vocabulary without it, or with repeated entries, is refused."""
    if not vocabulary or len(set(vocabulary)) != len(vocabulary):
        raise ValueError(f"vocabulary: {list(vocabulary)}")
    place = F.array_position(F.array(*[F.lit(v) for v in vocabulary]), value)
    return F.when(place > 0, place - 1).otherwise(F.lit(0)).cast("int")


def linear(intercept: float, terms: Sequence[tuple[float, Column]]) -> Column:
    """Intercept and products, added in feature order."""
    out = F.lit(float(intercept))
    for c, x in terms:
        out = out + F.lit(float(c)) * x
    return out


def probability(score: Column, limit: float = 36.0) -> Column:
    """The sigmoid, 0 and 1 beyond the limit, computed without overflow; never -0."""
    positive, negative = 1 / (1 + F.exp(-score)), F.exp(score) / (1 + F.exp(score))
    return F.when(score >= limit, 1.0).when(score <= -limit, 0.0).when(score >= 0, positive).otherwise(negative) + F.lit(0.0)


#: Exact scores: fifty digits; a probability has fifteen places and is 0 or 1 beyond the limit.
_CONTEXT = Context(prec=50, rounding=ROUND_HALF_EVEN)
_PLACES, _LIMIT = Decimal("1e-15"), Decimal(36)


def _exact_probability(z: Decimal) -> Decimal:
    with localcontext(_CONTEXT):
        if abs(z) >= _LIMIT:
            p = Decimal(1 if z > 0 else 0)
        else:
            p = 1 / (1 + (-z).exp())
        return abs(p.quantize(_PLACES))


def exact_probability(intercept: str, coefficients: Sequence[str], features: Sequence[Column]) -> Column:
    """The probability of a logistic model in decimals of 50 digits, half-even: products and sums in feature order, each rounded. Coefficients are decimal texts; a feature counts with the exact value of its double. Null or non-finite features give null. No built-in type has so many digits, so this is an Arrow function."""
    first, each = Decimal(intercept), [Decimal(c) for c in coefficients]

    @F.pandas_udf("decimal(16,15)")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            out = []
            with localcontext(_CONTEXT):
                for row in zip(*columns, strict=True):
                    if any(x is None or x != x or x in (float("inf"), float("-inf")) for x in row):
                        out.append(None)
                        continue
                    z = +first
                    for c, x in zip(each, row, strict=True):
                        z += c * Decimal(x)
                    out.append(_exact_probability(z))
            yield pd.Series(out, dtype=object)

    return score(*[f.cast("double") for f in features])


def one_hot(index: Column, size: int) -> list[Column]:
    """A column of 1 or 0 for each entry of a vocabulary."""
    return [F.when(index == i, 1.0).otherwise(0.0) for i in range(size)]


def model_report(models: DataFrame) -> DataFrame:
    """Per model_id what is wrong with a model record (feature_names, coefficients, classes, positive_class, intercept, contract_features: the feature order of its contract), gated. With vocabularies and vocabulary_coefficients (maps from a category's column to its entries, the first for the unknown, and their weights), these too; and where a model_id has several records, none is sound."""
    names, values = F.col("feature_names"), F.col("coefficients")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    wrong = lambda ok: (~F.coalesce(ok, F.lit(False))).cast("long")
    rules = {
        "coefficient_count": wrong(F.size(values) == F.size(names)), "repeated_names": wrong(F.size(F.array_distinct(names)) == F.size(names)), "not_finite": wrong(F.forall(values, finite) & finite(F.col("intercept"))),
        "positive_class": wrong((F.size("classes") == 2) & (F.get("classes", F.lit(1)) == F.col("positive_class"))), "feature_order": wrong(names == F.col("contract_features")),
    }
    if "vocabularies" in models.columns:
        words, weights = F.col("vocabularies"), F.col("vocabulary_coefficients")
        same = F.forall(F.map_keys(words), lambda c: F.coalesce(F.size(F.try_element_at(weights, c)) == F.size(words[c]), F.lit(False)))
        rules["vocabulary_size"] = wrong((F.size(words) == F.size(weights)) & same & F.forall(F.map_values(words), lambda v: F.size(v) > 0))
        rules["repeated_entries"] = wrong(F.forall(F.map_values(words), lambda v: F.size(F.array_distinct(v)) == F.size(v)))
        rules["vocabulary_not_finite"] = wrong(F.forall(F.map_values(weights), lambda w: F.forall(w, finite)))
    d = models.select("model_id", *[c.alias(name) for name, c in rules.items()])
    twice = models.groupBy("model_id").agg((F.count("*") - 1).alias("repeated_records")).filter("repeated_records > 0").withColumnRenamed("model_id", "_twice")
    d = d.join(twice, d["model_id"].eqNullSafe(twice["_twice"]), "left").drop("_twice").withColumn("repeated_records", F.coalesce("repeated_records", F.lit(0)))
    return gate(d, [*rules, "repeated_records"])


def score_by_models(rows: DataFrame, models: DataFrame, categories: Sequence[str] = (), places: int | None = None) -> DataFrame:
    """rows with probability and refused. Each row names its model (model_id); models holds records as model_report() describes them, one for each id. A record that fails a rule scores nothing: its rows have null and its failures, those of an unknown model 'unknown_model'.

    A model's features are columns of rows by name, so models of different features score in one job: the products are summed in the order of its own
    features, from the intercept, then the weights of its categories in the given order, as linear() does. A row with a null feature, or a blank category of its model, has no probability. The
    registry is one row for each model and is joined by id."""
    report = model_report(models).select(F.col("model_id").alias("_id"), F.col("failures").alias("_failures"))
    once = models.dropDuplicates(["model_id"])
    known = once.join(report.dropDuplicates(["_id"]), once["model_id"].eqNullSafe(F.col("_id"))).select(F.col("_id").alias("_model"), F.struct(*[F.col(c) for c in once.columns if c != "model_id"]).alias("_m"), "_failures")
    j = rows.join(known, rows["model_id"] == known["_model"], "left")
    numeric = [c for c, t in rows.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")]
    values = F.create_map(*[x for c in numeric for x in (F.lit(c), F.col(f"`{c}`").cast("double"))]) if numeric else F.create_map().cast("map<string,double>")
    mine = F.transform("_m.feature_names", lambda name: F.try_element_at(values, name))
    score = F.aggregate(F.zip_with("_m.coefficients", mine, lambda w, x: w * x), F.col("_m.intercept").cast("double"), lambda at, x: at + x)
    blank = F.lit(False)
    for c in categories if "vocabularies" in models.columns else ():
        words, weights = F.try_element_at("_m.vocabularies", F.lit(c)), F.try_element_at("_m.vocabulary_coefficients", F.lit(c))
        place = F.array_position(words, F.col(c).cast("string"))
        used = words.isNotNull()
        score = score + F.when(used, F.get(weights, F.when(place > 0, place - 1).otherwise(0).cast("int"))).otherwise(0.0)
        blank = blank | (used & (F.coalesce(F.col(c).cast("string"), F.lit("")) == ""))
    p = probability(score) if places is None else F.bround(probability(score), places).cast(f"decimal({places + 1},{places})")
    refused = F.when(F.col("_model").isNull(), "unknown_model").when(F.col("_failures") != "", F.col("_failures"))
    return j.withColumn("probability", F.when(refused.isNull() & ~blank, p)).withColumn("refused", refused).drop("_model", "_m", "_failures")


def blank_inputs(df: DataFrame, columns: Sequence[str]) -> Column:
    """Rows in which a category is null or empty, which no vocabulary may stand for."""
    return count_where(F.greatest(*[(F.coalesce(F.col(c), F.lit("")) == "") for c in columns]) if len(columns) > 1 else F.coalesce(F.col(columns[0]), F.lit("")) == "")
