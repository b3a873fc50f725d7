"""A trained text classifier: naive Bayes over tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import tokens
from tidewatch.operators.bayes import ITEM, PRIOR, UNSEEN, best_label, fit_scores, single, with_scores
from tidewatch.session import stage


def fit_text_classifier(df: DataFrame, label_col: str, text: str = "text", path: str | None = None) -> DataFrame:
    """The scores of every token, written to shared storage; runs jobs when called. Labels become text."""
    labelled = df.filter(F.col(label_col).isNotNull()).select(F.col(label_col).cast("string").alias("label"), tokens(F.col(text)).alias("t"))
    counts = labelled.select("label", F.explode("t").alias("item")).groupBy("label", "item").agg(F.count("*").alias("n"))
    documents = labelled.groupBy("label").agg(F.count("*").alias("n"))
    return stage(fit_scores(stage(counts, "token-counts"), documents), "classifier", path)


def classify(df: DataFrame, model: DataFrame, key: str = "post_id", text: str = "text") -> DataFrame:
    """Adds ``prediction``, a label; ``key`` must be unique. Texts without tokens take the label with the best prior."""
    prior, unseen = single(model, PRIOR), single(model, UNSEEN)
    rows = df.select(key, F.explode(tokens(F.col(text))).alias("item"))
    known = model.filter(F.col("kind") == ITEM).select("item", "scores")
    found = best_label(with_scores(rows, known, "item", "scores"), key, ["scores"], unseen, "prediction", prior)
    default = min(prior, key=lambda label: (-prior[label], label))
    return df.drop("prediction").join(found, key, "left").withColumn("prediction", F.coalesce("prediction", F.lit(default)))
