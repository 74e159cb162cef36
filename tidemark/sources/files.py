"""Sources and sinks: lists, sections, probes, manifests, tensor headers, stills, reports.

Everything that grows is read by Spark; single small files of configuration are read
by the driver.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator, Sequence
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import fraction, number_pair, without_comment


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """``line``: distinct lines without ``#`` comments and blanks."""
    return spark.read.text(path).select(without_comment(F.col("value")).alias("line")).where("line <> ''").distinct()


def read_allow_list(spark: SparkSession, path: str) -> DataFrame:
    """path, low, high of lines ``path [a-b]``."""
    x = read_list(spark, path).withColumn("p", F.split("line", r"\s+"))
    pair = number_pair(F.try_element_at("p", F.lit(2)))
    return x.select(F.col("p")[0].alias("path"), pair["low"].alias("low"), pair["high"].alias("high"))


def read_probes(spark: SparkSession, path: str) -> DataFrame:
    """One typed row per probe JSON: geometry, rates, variable-rate flag, frame count and where it came from."""
    schema = (
        "format struct<filename:string,duration:string>, streams array<struct<codec_type:string,codec_name:string,width:int,height:int,"
        "r_frame_rate:string,avg_frame_rate:string,nb_frames:string,nb_read_packets:string,sample_aspect_ratio:string,channels:int,tags:map<string,string>>>"
    )
    x = spark.read.schema(schema).option("multiLine", True).json(path)
    of = lambda kind: F.filter("streams", lambda s: s["codec_type"] == kind)
    v = F.get(of("video"), 0)
    fps, avg, duration = fraction(v["r_frame_rate"]), fraction(v["avg_frame_rate"]), F.col("format.duration").try_cast("double")
    exact, stated, guess = v["nb_read_packets"].try_cast("long"), v["nb_frames"].try_cast("long"), F.round(duration * fps).cast("long")
    return x.select(
        F.col("format.filename").alias("file"), v["width"].alias("width"), v["height"].alias("height"), fps.alias("fps"),
        F.coalesce(F.abs(fps - avg) / F.nullif(fps, F.lit(0.0)) > 0.01, F.lit(False)).alias("variable_rate"), duration.alias("duration"),
        F.coalesce(exact, stated, guess).alias("frames"),
        F.when(exact.isNotNull(), "packets").when(stated.isNotNull(), "stated").when(guess.isNotNull(), "estimated").alias("frames_from"),
        F.transform(of("audio"), lambda a: F.struct(a["codec_name"].alias("codec"), a["channels"].alias("channels"))).alias("audio"),
    )


def require_probe(probes: DataFrame) -> DataFrame:
    """Fails on a row without rate or duration."""
    ok = (F.col("fps") > 0) & F.col("duration").isNotNull()
    return probes.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no rate or duration: "), "file"))))


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, modified, length of a tree's files; contents are not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return r.load(path).select("path", F.col("modificationTime").alias("modified"), "length")


def single_file(spark: SparkSession, path: str, extensions: Sequence[str], what: str) -> str:
    """The only file with one of the extensions; none or several is an error."""
    glob = "*.{" + ",".join(e.lstrip(".") for e in extensions) + "}"
    rows = list_files(spark, path, glob).select("path").orderBy("path").limit(6).collect()
    if len(rows) != 1:
        raise FileNotFoundError(f"{'no' if not rows else 'more than one'} {what} in {path}" + "".join(f"\n  {r['path']}" for r in rows))
    return rows[0]["path"]


def read_tensor_headers(spark: SparkSession, path: str, glob: str = "*.safetensors") -> DataFrame:
    """file, name, dtype, shape, numel from the JSON headers: a little-endian u64 length, then the JSON.

    Only the headers are read, so a file may have any size.  A length outside (0, 2^28)
    is an error, as is a file that ends inside its header.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        for batch in batches:
            heads, digests = [], []
            for name in batch["path"].to_pylist():
                fs, at = FileSystem.from_uri(name.replace("file:/", "file:///", 1) if name.startswith("file:/") and not name.startswith("file://") else name)
                with fs.open_input_file(at) as f:
                    n = int.from_bytes(f.read(8), "little")
                    text = f.read(n) if 0 < n < 1 << 28 else b""
                if not text or len(text) != n:
                    raise ValueError(f"bad header length in {name}")
                heads.append(text.decode())
                digests.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays([batch["path"], pa.array(heads, pa.string()), pa.array(digests, pa.string())], ["file", "head", "digest"])

    m = F.from_json("head", "map<string,struct<dtype:string,shape:array<bigint>>>")
    rows = files.mapInArrow(run, "file string, head string, digest string").select("file", "digest", F.explode(m).alias("name", "t")).where("name <> '__metadata__'")
    return rows.select("file", "name", "t.dtype", "t.shape", F.aggregate("t.shape", F.lit(1).cast("long"), lambda a, b: a * b).alias("numel"), F.substring("digest", 1, 16).alias("header_digest"))


def read_stills(spark: SparkSession, path: str, glob: str = "*.pgm") -> DataFrame:
    """path, height, width, pixels (binary) of 8-bit grey PGM files; a corrupt file has null pixels."""
    x = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    head = F.regexp_extract(F.decode(F.substring("content", 1, 64), "ISO-8859-1"), r"^P5\s+(\d+)\s+(\d+)\s+255\s", 0)
    dims = [F.regexp_extract(head, r"^P5\s+(\d+)\s+(\d+)", k).try_cast("int") for k in (1, 2)]
    w, h = dims
    body = F.substring("content", F.length(head) + 1, F.octet_length("content"))
    return x.select("path", h.alias("height"), w.alias("width"), F.when(F.octet_length(body) == w * h, body).alias("pixels"))


def decode_picture(raw: bytes) -> np.ndarray | None:
    """RGB pixels (height, width, 3) of an 8-bit PNG (grey or colour, with or without alpha) or a binary PGM or PPM; None if it is broken or of another kind."""
    try:
        if raw[:2] in (b"P5", b"P6"):
            head = raw.split(maxsplit=4)
            w, h, top, n = int(head[1]), int(head[2]), int(head[3]), 3 if raw[:2] == b"P6" else 1
            body = raw[len(raw) - w * h * n :]
            if top != 255 or len(raw) <= w * h * n:
                return None
            a = np.frombuffer(body, np.uint8).reshape(h, w, n)
        else:
            a = _png(raw)
    except (ValueError, IndexError, struct.error, zlib.error, KeyError):
        return None
    a = a[..., : 1 if a.shape[2] < 3 else 3]
    return np.ascontiguousarray(np.broadcast_to(a, (*a.shape[:2], 3)))


def _png(raw: bytes) -> np.ndarray:
    if raw[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, data, shape = 8, b"", None
    while at < len(raw):
        n, kind = struct.unpack(">I4s", raw[at : at + 8])
        body = raw[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack(">I", raw[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("wrong checksum")
        if kind == b"IHDR":
            w, h, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", body)
            if depth != 8 or interlaced:
                raise ValueError("not 8 bits, or interlaced")
            shape = (h, w, {0: 1, 2: 3, 4: 2, 6: 4}[colour])
        elif kind == b"IDAT":
            data += body
        at += 12 + n
    h, w, c = shape or (0, 0, 1)
    rows = np.frombuffer(zlib.decompress(data), np.uint8).reshape(h, 1 + w * c)
    out = np.zeros((h + 1, w + 1, c), np.int64)  # with a black row above and column before
    for y in range(h):
        f, line = int(rows[y, 0]), rows[y, 1:].reshape(w, c).astype(np.int64)
        up = out[y]
        if f == 0:
            out[y + 1, 1:] = line
        elif f == 1:
            out[y + 1, 1:] = np.cumsum(line, 0) & 255
        elif f == 2:
            out[y + 1, 1:] = (line + up[1:]) & 255
        elif f in (3, 4):
            for x in range(w):
                a, b, d = out[y + 1, x], up[x + 1], up[x]
                if f == 3:
                    guess = (a + b) // 2
                else:
                    pa_, pb, pd = abs(b - d), abs(a - d), abs(a + b - 2 * d)
                    guess = np.where((pa_ <= pb) & (pa_ <= pd), a, np.where(pb <= pd, b, d))
                out[y + 1, x + 1] = (line[x] + guess) & 255
        else:
            raise ValueError("unknown filter")
    return out[1:, 1:].astype(np.uint8)


def read_pictures(spark: SparkSession, path: str, glob: str = "*.{png,pgm,ppm}") -> DataFrame:
    """path, height, width, pixels (RGB, binary); a broken file has nulls."""
    x = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [decode_picture(c) for c in batch["content"].to_pylist()]
            size = lambda i: pa.array([None if a is None else a.shape[i] for a in got], pa.int32())
            yield pa.RecordBatch.from_arrays([batch["path"], size(0), size(1), pa.array([None if a is None else a.tobytes() for a in got], pa.binary())], ["path", "height", "width", "pixels"])

    return x.mapInArrow(run, "path string, height int, width int, pixels binary")


def interval_scan(frames: DataFrame, start: int, stop: int, exact: bool = True) -> DataFrame:
    """Frames of [start, stop); with ``exact``, a wrong number of frames is an error."""
    x = frames.where((F.col("frame") >= start) & (F.col("frame") < stop))
    if exact and (n := x.count()) != stop - start:
        raise ValueError(f"{n} frames in [{start}, {stop})")
    return x


def lockstep(*streams: DataFrame, keys: Sequence[str] = ("frame",), exact: bool = True) -> DataFrame:
    """Streams joined frame by frame; with ``exact``, streams of different lengths are an error."""
    if exact and len({s.count() for s in streams}) > 1:
        raise ValueError("the streams have different lengths")
    out = streams[0]
    for s in streams[1:]:
        out = out.join(s, list(keys))
    return out


def write_nonempty(df: DataFrame, path: str, format: str = "parquet", **options: Any) -> None:
    """Write, refusing an empty result."""
    if not df.limit(1).count():
        raise ValueError(f"nothing to write to {path}")
    df.write.format(format).options(**options).mode("errorifexists").save(path)


def write_csv(df: DataFrame, path: str, blank: Sequence[str] = ()) -> None:
    """CSV with a header and empty columns for people to fill in."""
    df.select("*", *(F.lit("").alias(c) for c in blank)).write.option("header", True).option("emptyValue", "").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def markdown(df: DataFrame, most: int = 1000) -> str:
    """A small result as a Markdown table; more than ``most`` rows is an error."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows do not make a report")
    line = lambda xs: "| " + " | ".join("" if x is None else str(x) for x in xs) + " |"
    return "\n".join([line(df.columns), line("---" for _ in df.columns), *(line(r) for r in rows)])


def merge_config(base: Any, over: Any) -> Any:
    """``over`` wins; maps merge level by level, everything else replaces."""
    if isinstance(base, dict) and isinstance(over, dict):
        return {k: merge_config(base[k], over[k]) if k in base and k in over else over.get(k, base.get(k)) for k in [*base, *(k for k in over if k not in base)]}
    return over


def _parsed(path: Path) -> dict:
    if path.suffix.lower() not in (".yaml", ".yml"):
        return json.loads(path.read_text())
    try:
        import yaml
    except ImportError as e:
        raise ImportError(f"{path} needs the yaml module") from e
    return yaml.safe_load(path.read_text()) or {}


def load_config(path: str, key: str = "extends") -> dict:
    """A JSON or YAML configuration with its chain of parents merged; a loop is an error."""
    seen, layers, p = set(), [], Path(path)
    while p:
        p = p.resolve()
        if p in seen:
            raise ValueError(f"{p} extends itself")
        seen.add(p)
        layer = _parsed(p)
        up = layer.pop(key, None)
        layers.append(layer)
        p = p.parent / up if up else None
    out: dict = {}
    for layer in reversed(layers):
        out = merge_config(out, layer)
    return out


def stack(spec: Any) -> list[dict]:
    """None, a name, a map or a list of those as a list of {name, strength}; duplicates, paths outside and bad strengths are errors."""
    items = [] if spec in (None, "") else spec if isinstance(spec, list) else [spec]
    out = []
    for i in items:
        i = {"name": i} if isinstance(i, str) else i
        if not isinstance(i, dict) or not i.get("name"):
            raise ValueError(f"not an entry: {i!r}")
        if ".." in Path(i["name"]).parts or Path(i["name"]).is_absolute():
            raise ValueError(f"{i['name']} leaves the folder")
        strength = i.get("strength", 1.0)
        if isinstance(strength, bool) or not isinstance(strength, (int, float)):
            raise ValueError(f"{i['name']}: strength {strength!r}")
        out.append({"name": i["name"], "strength": float(strength)})
    if len({x["name"] for x in out}) != len(out):
        raise ValueError("an entry is given twice")
    return out


def list_archives(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """path, member, size of the entries of zip archives; contents are not unpacked."""
    import io
    import zipfile

    import pandas as pd

    def run(batches):
        for batch in batches:
            rows = [(p, i.filename, i.file_size) for p, c in zip(batch["path"], batch["content"]) for i in zipfile.ZipFile(io.BytesIO(c)).infolist()]
            yield pd.DataFrame(rows, columns=["path", "member", "size"])

    x = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return x.select("path", "content").mapInPandas(run, "path string, member string, size long")


def generate_frames(spark: SparkSession, streams: int, frames: int, cut: int, seed: int = 7) -> DataFrame:
    """A seeded synthetic series per stream with one scene change at ``cut``."""
    x = spark.range(streams * frames).select((F.col("id") / frames).cast("long").alias("stream"), (F.col("id") % frames).alias("frame"))
    noise = F.pmod(F.xxhash64(F.lit(seed), "stream", "frame"), F.lit(1000)) / 1000.0
    return x.withColumn("value", F.when(F.col("frame") < cut, 10.0).otherwise(90.0) + noise)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)
