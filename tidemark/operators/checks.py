"""Checks with messages: settings, streams, clips, bindings, patterns, presence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def problems(**rules: Column) -> Column:
    """Names of the rules that a row breaks, in the order given; a rule that is null is not broken."""
    return F.filter(F.array(*(F.when(broken, F.lit(name)) for name, broken in rules.items())), lambda p: p.isNotNull())


def setting_problems(length: Column, width: Column, height: Column, overlap: Column, polarity: Column) -> Column:
    """Lengths are 4n + 1, sizes multiples of 16, the overlap is shorter than a chunk, white is regenerated."""
    return problems(length=(length - 1) % 4 != 0, width=width % 16 != 0, height=height % 16 != 0, overlap=overlap >= length, polarity=~polarity.eqNullSafe(F.lit("white_is_regenerate")))


def illegal_chunks(chunks: DataFrame, length: str) -> DataFrame:
    """Chunks whose length is not 4n + 1, with the nearest one below that is."""
    n = F.col(length)
    return chunks.where((n - 1) % 4 != 0).withColumn("legal", F.floor((n - 1) / 4) * 4 + 1)


def clip_problems(got: Column, want: Column) -> Column:
    """A clip against what was asked for; both are structs of frames, width, height, fps, duration, audio.

    A missing clip is that and nothing more.
    """
    rest = problems(
        frames=F.abs(got["frames"] - want["frames"]) > 2,
        size=(got["width"] != want["width"]) | (got["height"] != want["height"]),
        rate=F.abs(got["fps"] - want["fps"]) > 0.02,
        duration=F.abs(got["duration"] - want["duration"]) > 0.2,
        audio=want["audio"] & ~F.coalesce(got["audio"], F.lit(False)),
    )
    return F.when(got.isNull() | F.coalesce(got["frames"] == 0, F.lit(True)), F.array(F.lit("missing"))).otherwise(rest)


def sync_problems(video: Column, audio: Column, expected: Column) -> Column:
    """Video and audio drift apart by at most 0.15 s, and the length is kept to 0.25 s; no audio drifts never."""
    return problems(drift=F.abs(video - audio) > 0.15, length=F.abs(video - expected) > 0.25)


def unbound(modules: DataFrame, names: DataFrame, key: Sequence[str], module: str, name: str) -> DataFrame:
    """key, modules, unbound, ok: whether every module of a group has a name of its own in ``names``; an empty group is not in order."""
    have = names.select(*key, F.col(name).alias(module), F.lit(1).alias("__bound")).distinct()
    x = modules.join(have, [*key, module], "left").groupBy(*key).agg(F.count(module).alias("modules"), F.count_if(F.col("__bound").isNull() & F.col(module).isNotNull()).alias("unbound"))
    return x.withColumn("ok", (F.col("unbound") == 0) & (F.col("modules") > 0))


def broken_guards(patterns: DataFrame, section: str, pattern: str, sections: Sequence[str]) -> DataFrame:
    """section, problem: sections that are absent or empty, and patterns that do not compile.

    A guard that finds nothing because its patterns are broken must not report success.
    Every non-blank pattern is compiled once by the engine that applies them.
    """
    spark = patterns.sparkSession
    filled = patterns.where(F.trim(pattern) != "").select(F.col(section).alias("section"), F.col(pattern).alias("pattern"))
    empty = spark.createDataFrame([(s,) for s in sections], "section string").join(filled.select("section").distinct(), "section", "left_anti").select("section", F.lit("missing or empty").alias("problem"))
    java = spark._jvm.java.util.regex.Pattern

    def compiles(p: str) -> bool:
        try:
            java.compile(p)
        except Exception:
            return False
        return True

    # a vocabulary file: small, and read by the driver like any configuration
    bad = [(r["section"], "not a pattern") for r in filled.distinct().collect() if not compiles(r["pattern"])]
    return empty.union(spark.createDataFrame(bad, "section string, problem string").distinct())


def unequal(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """keys, field, values: groups whose rows do not agree in a field that they have to share (null counts as a value)."""
    parts = [F.count_distinct(F.coalesce(F.col(f).cast("string"), F.lit("\0"))).alias(f) for f in fields]
    x = df.groupBy(*keys).agg(*parts)
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("values")) for f in fields))).alias("p")
    return x.select(*keys, pairs).where("p.values > 1").select(*keys, "p.field", "p.values")


def require_equal(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """``df``, or an error that names a group in disagreement."""
    bad = unequal(df, keys, fields).limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0].asDict()}: rows disagree")
    return df


def binding_problems(bindings: DataFrame, role: str, required: Mapping[str, Sequence[str]]) -> DataFrame:
    """role, key: settings that a role needs and that are absent or blank; a role without any row lacks all."""
    wanted = bindings.sparkSession.createDataFrame([(r, k) for r, keys in required.items() for k in keys], "role string, key string")
    have = bindings.where(F.trim(F.col("value")) != "").select(F.col(role).alias("role"), "key").distinct()
    return wanted.join(have, ["role", "key"], "left_anti")


def presence(wanted: DataFrame, have: DataFrame, name: str) -> DataFrame:
    """name, ok, detail of every wanted thing."""
    x = wanted.select(name).distinct().join(have.select(name, F.lit(True).alias("ok")).distinct(), name, "left")
    ok = F.coalesce("ok", F.lit(False))
    return x.select(name, ok.alias("ok"), F.when(~ok, "missing").alias("detail"))
