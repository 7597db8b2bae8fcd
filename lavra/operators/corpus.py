"""Counts and listings over the file inventory, copy status and log suppression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.functions import paths


def extension_profile(files: DataFrame, path: str, fallback: str = "(Without extension)") -> DataFrame:
    """(format, quantity, percentual): files by extension, most frequent first, ties by first path."""
    ext = paths.suffix(paths.basename(F.col(path)))
    counts = files.groupBy(F.coalesce(F.nullif(ext, F.lit("")), F.lit(fallback)).alias("format")).agg(F.count("*").alias("quantity"), F.min(path).alias("_first"))
    share = F.bround(F.col("quantity") * F.lit(100.0) / F.sum("quantity").over(Window.partitionBy()), 2)  # one row per extension
    return counts.select("format", "quantity", share.alias("percentual"), "_first").orderBy(F.desc("quantity"), "_first").drop("_first")


def distinct_extensions(files: DataFrame, path: str) -> DataFrame:
    return files.select(paths.suffix(paths.basename(F.col(path))).alias("format")).where("format <> ''").distinct().orderBy("format")


def extension_groups(files: DataFrame, path: str) -> DataFrame:
    """(groups): how many different extensions there are, files without one being a group of their own."""
    return files.agg(F.count_distinct(F.coalesce(paths.suffix(paths.basename(F.col(path))), F.lit(""))).alias("groups"))


def first_segments(keys: DataFrame, key: str) -> DataFrame:
    """(prefix): distinct first path segments of keys that lie in a folder."""
    return keys.where(F.col(key).contains("/")).select(F.concat(F.substring_index(key, "/", 1), F.lit("/")).alias("prefix")).distinct()


def sub_folders(keys: DataFrame, key: str, prefix: str) -> DataFrame:
    """(prefix): distinct folders directly below ``prefix``."""
    rest = F.substring(F.col(key), F.lit(len(prefix) + 1), F.char_length(key))
    return keys.where(F.col(key).startswith(prefix) & rest.contains("/")).select(F.concat(F.lit(prefix), F.substring_index(rest, "/", 1), F.lit("/")).alias("prefix")).distinct()


def under(keys: DataFrame, key: str, prefix: str, page: int | None = None) -> DataFrame:
    """Keys below a prefix; with ``page`` only the first so many in key order, as one listing page has them."""
    live = keys.where(F.col(key).startswith(prefix))
    return live.orderBy(key).limit(page) if page else live


def copy_status(wanted: DataFrame, source: str, target: str, existing: DataFrame, key: str) -> DataFrame:
    """``wanted`` with ``status``: not_found without its source, skipped where the target exists, else copy."""
    have = existing.select(F.col(key).alias("_k")).where(F.col(key).isNotNull()).distinct()
    s, t = have.select(F.col("_k").alias(source), F.lit(True).alias("_s")), have.select(F.col("_k").alias(target), F.lit(True).alias("_t"))
    joined = wanted.join(s, source, "left").join(t, target, "left")
    return joined.withColumn("status", F.when(F.col("_s").isNull(), "not_found").when(F.col("_t").isNotNull(), "skipped").otherwise("copied")).drop("_s", "_t")


def summary(status: DataFrame) -> DataFrame:
    """(processed, copied, not_found) of a copy run."""
    return status.agg(F.count("*").alias("processed"), F.count_if(F.col("status") == "copied").alias("copied"), F.count_if(F.col("status") == "not_found").alias("not_found"))


def suppressed_by(logger: Column, message: Column, rule_logger: Column, rule_message: Column) -> Column:
    return logger.contains(rule_logger) & message.contains(rule_message)


def suppress(lines: DataFrame, rules: DataFrame, max_rules: int = 10_000) -> DataFrame:
    """Log lines that no rule suppresses: a rule matches by substring of both the logger name and the message.

    Null names and messages match no rule. Rules are few by nature; they are broadcast only after a check of
    their number, beyond it distinct lines are matched against them in a theta join without a hint.
    """
    few = rules.limit(max_rules + 1).count() <= max_rules
    r = rules.select(F.col("logger_name").alias("_rl"), F.col("message_pattern").alias("_rm")).distinct()
    hit = suppressed_by(F.col("logger_name"), F.col("message"), F.col("_rl"), F.col("_rm"))
    if few:
        return lines.join(F.broadcast(r), hit, "left_anti")
    drop = lines.select("logger_name", "message").distinct().join(r, hit, "left_semi")
    return lines.join(drop, ["logger_name", "message"], "left_anti")
