"""Cleaning of raw metadata and data quality rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch import constants as K
from scorewatch.functions import labels, texts
from scorewatch.schemas import CLEAN_IMAGES, FEEDBACK, conform, required_columns


def silver_transform(images: DataFrame, processed_at: Column) -> DataFrame:
    """Clean metadata: label, local path, quality score, batch of origin.

    ``quality_score`` is the share of four checks that hold: id present, path present, size above
    0, known class. Rows below 1 are kept. Width and height are not in the raw data. An unknown
    class has no label.
    """
    known = F.col("category").isin(K.POSITIVE_CLASS, K.NEGATIVE_CLASS)
    checks = [
        F.col("image_id").isNotNull() & (F.col("image_id") != ""),
        F.col("file_path").isNotNull() & (F.col("file_path") != ""),
        F.col("file_size_bytes") > 0,
        known,
    ]
    passed = sum((F.coalesce(c, F.lit(False)).cast("int") for c in checks), F.lit(0))
    return conform(
        images.select(
            "image_id",
            F.when(known, labels.encode_label(F.col("category"))).alias("label"),
            F.col("category").alias("label_name"),
            "dataset_split",
            texts.strip_storage_prefix(F.col("file_path")).alias("file_path"),
            (passed / F.lit(float(len(checks)))).alias("quality_score"),
            processed_at.alias("processed_at"),
            F.col("ingestion_batch_id").alias("source_batch_id"),
        ),
        CLEAN_IMAGES,
    )


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule, all rules in one pass: rule, failed, total.

    A rule is a condition that must be TRUE; FALSE and NULL break it.
    """
    failed = [F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]
    counts = df.agg(F.count("*").alias("total"), *failed)
    entries = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("failed")) for n in rules])
    return counts.select(F.explode(entries).alias("entry"), "total").select("entry.rule", "entry.failed", "total")


def key_rules(tables: Mapping[str, DataFrame], unique: Mapping[str, str], references: Mapping[tuple[str, str], str]) -> DataFrame:
    """Rows beyond the first of their key, and rows whose key their parent table lacks: rule, failed, total.

    ``unique`` names each table's key, ``references`` the tables of (child, key) whose key must be in a parent.
    Every table is read once: its keys are tagged with what they are the key of, all tables' keys are counted
    together, and a key's counts as own and as reference tell duplicates and orphans. Counting combines before
    the shuffle, so hot keys stay small. A missing reference is another rule's business.
    """
    roles = {name: [(key, name, 1)] for name, key in unique.items()}
    for (child, key), parent in references.items():
        roles[child].append((key, parent, 0))
    tagged = None
    for name, uses in roles.items():
        entries = [
            F.struct(
                F.lit(of).alias("of"), F.lit(name).alias("name"), F.col(key).cast("string").alias("key"),
                F.lit(own).alias("own"),
            )
            for key, of, own in uses
        ]
        rows = tables[name].select(F.explode(F.array(*entries)).alias("k")).select("k.*")
        tagged = rows if tagged is None else tagged.unionByName(rows)
    users = [name for name, _ in references]
    used = lambda name: F.count_if((F.col("own") == 0) & (F.col("name") == name))
    per_key = tagged.groupBy("of", "key").agg(
        F.count_if(F.col("own") == 1).alias("rows"), *[used(n).alias(f"by_{n}") for n in users]
    )
    orphan = F.col("rows").eqNullSafe(0) & F.col("key").isNotNull()
    per_table = per_key.groupBy("of").agg(
        F.sum(F.greatest(F.col("rows") - 1, F.lit(0))).alias("repeated"),
        F.sum("rows").alias("rows"),
        *[F.sum(F.when(orphan, F.col(f"by_{n}")).otherwise(0)).alias(f"lost_{n}") for n in users],
        *[F.sum(f"by_{n}").alias(f"by_{n}") for n in users],
    )
    # Rules of the report with the count they are read from; an empty table has no count.
    wanted = [(f"{t}.{key} unique", t, "repeated", "rows") for t, key in unique.items()]
    wanted += [(f"{c}.{key} in {p}", p, f"lost_{c}", f"by_{c}") for (c, key), p in references.items()]
    rule = lambda r, t, failed, total: F.when(
        F.col("of") == t, F.struct(F.lit(r).alias("rule"), F.col(failed).alias("failed"), F.col(total).alias("total"))
    )
    found = per_table.select(F.explode(F.array_compact(F.array(*[rule(*w) for w in wanted]))).alias("r")).select("r.*")
    names = found.sparkSession.range(1).select(F.explode(F.array(*[F.lit(w[0]) for w in wanted])).alias("rule"))
    counts = names.join(found, "rule", "left")
    return counts.select("rule", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("failed", "total")])


def quality_report(images: DataFrame, predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """Completeness, enumerations, ranges, unique keys and references of the three tables."""
    image_rules = {
        "images.image_id present": F.col("image_id").isNotNull(),
        "images.category known": F.col("category").isin(K.POSITIVE_CLASS, K.NEGATIVE_CLASS),
        "images.dataset_split known": F.col("dataset_split").isin(*K.SPLITS),
        "images.file_size_bytes positive": F.col("file_size_bytes") > 0,
    }
    prediction_rules = {
        "predictions.prediction_probability in range": F.col("prediction_probability").between(0.0, 1.0),
        "predictions.confidence_score in range": F.col("confidence_score").between(0.5, 1.0),
        "predictions.predicted_label known": F.col("predicted_label").isin(0, 1),
        "predictions.image_id present": F.col("image_id").isNotNull(),
    }
    feedback_rules = {f"feedback.{c} present": F.col(c).isNotNull() for c in required_columns(FEEDBACK)}
    feedback_rules |= {
        "feedback.feedback_type known": F.col("feedback_type").isin(*K.OUTCOMES),
        "feedback.confidence known": F.col("confidence").isin(*K.CERTAINTY_LEVELS),
        "feedback.radiologist_id present": F.col("radiologist_id").isNotNull(),
    }
    keys = key_rules(
        {"images": images, "predictions": predictions, "feedback": feedback},
        unique={"images": "image_id", "predictions": "prediction_id", "feedback": "feedback_id"},
        references={("predictions", "image_id"): "images", ("feedback", "prediction_id"): "predictions"},
    )
    report = rule_counts(images, image_rules)
    for part in (rule_counts(predictions, prediction_rules), rule_counts(feedback, feedback_rules), keys):
        report = report.unionByName(part)
    return report
