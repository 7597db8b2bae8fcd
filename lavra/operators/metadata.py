"""Course metadata: nested documents to a keyed lookup, and the lookup of files by their path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions import paths


def lookup(documents: DataFrame, order: str) -> DataFrame:
    """(key, turma, plano_aula, arquivo) from professor documents with turmas > planos_aula > arquivos.

    The key is the folder of ``path_local`` without its first 'files/', then '/' and the file name; entries
    without either are left out, of equal keys the last one in document order (``order``, then positions) wins.
    """
    t = documents.select(F.col(order).alias("_p0"), F.posexplode("turmas").alias("_p1", "_t"))
    p = t.select("_p0", "_p1", F.col("_t").dropFields("planos_aula").alias("turma"), F.posexplode("_t.planos_aula").alias("_p2", "_p"))
    a = p.select("_p0", "_p1", "_p2", "turma", F.col("_p").dropFields("arquivos").alias("plano_aula"), F.posexplode("_p.arquivos").alias("_p3", "arquivo"))
    full = a.where((F.coalesce("arquivo.path_local", F.lit("")) != "") & (F.coalesce("arquivo.nome_arquivo", F.lit("")) != ""))
    folder = paths.parent(paths.without_first_files(F.col("arquivo.path_local")))
    keyed = full.select(F.concat(folder, F.lit("/"), F.col("arquivo.nome_arquivo")).alias("key"), F.struct("turma", "plano_aula", "arquivo").alias("_v"), F.struct("_p0", "_p1", "_p2", "_p3").alias("_o"))
    return keyed.groupBy("key").agg(F.max_by("_v", "_o").alias("_v")).select("key", "_v.*")


def candidates(files: DataFrame, path: str) -> DataFrame:
    """(path, pos, key): the lookup keys a path may have, in the order they are tried.

    Only the leftmost date triple of a path counts; every later segment may be the file name.
    """
    seg = files.select(path, paths.parts(F.col(path)).alias("_s")).withColumn("_d", paths.date_index(F.col("_s")))
    live = seg.where(F.col("_d").isNotNull())
    day = F.array_join(F.slice("_s", F.col("_d") + 1, F.lit(3)), "/")
    rows = live.select(path, day.alias("_day"), F.posexplode(F.slice("_s", F.col("_d") + 4, F.size("_s"))).alias("pos", "_name"))
    return rows.select(path, "pos", F.concat_ws("/", "_day", "_name").alias("key"))


def attach(files: DataFrame, path: str, table: DataFrame, value: Column, out: str = "class_metadata") -> DataFrame:
    """``files`` with the value of the first candidate key that the lookup holds, null where none does.

    Distinct paths are looked up once, so a path shared by many rows is not a hot key of the candidate join.
    """
    keys = candidates(files.select(path).where(F.col(path).isNotNull()).distinct(), path)
    hit = keys.join(table.select("key", value.alias("_v")), "key").groupBy(path).agg(F.min_by("_v", "pos").alias(out))
    return files.drop(out).join(hit, path, "left")
