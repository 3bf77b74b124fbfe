"""Sniffed CSV, companion files, zone archives and side files."""

from __future__ import annotations

import io
import os
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sniff_csv(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """A CSV of unknown delimiter with or without a caption line above its header.

    Of ``;`` and ``,`` the more frequent in the head is the delimiter; a first line of
    under five columns is a caption. Only the head is read on the driver; the rows
    are parsed by executors. All columns are strings.
    """
    # The text source reads UTF-8 only; CSV with a delimiter that never occurs gives whole lines in any encoding.
    raw = spark.read.schema("value string").option("encoding", encoding).option("sep", "\u0001").option("quote", "").csv(path)
    head = raw.limit(20).collect()
    lines = [r.value for r in head]
    if not lines:
        return spark.createDataFrame([], "value string")
    text = "\n".join(lines)[:8192]
    sep = ";" if text.count(";") >= text.count(",") else ","
    at = 0 if len(lines[0].split(sep)) >= 5 or len(lines) == 1 else 1
    names = [c.strip().strip('"').lstrip("﻿") for c in lines[at].split(sep)]
    schema = ", ".join(f"`{c or f'_c{i}'}` string" for i, c in enumerate(names))
    skip = lines[: at + 1]
    rows = raw.where(~F.col("value").isin(*skip) & (F.trim("value") != ""))
    return rows.select(F.from_csv("value", schema, {"sep": sep}).alias("r")).select("r.*")


def guess_columns(columns: list[str], candidates: dict[str, list[str]]) -> dict[str, str | None]:
    """For each field the column that equals a candidate, case aside, else one that contains it, else None."""
    low = {c.lower(): c for c in columns}
    out: dict[str, str | None] = {}
    for field, names in candidates.items():
        exact = next((low[n.lower()] for n in names if n.lower() in low), None)
        out[field] = exact or next((c for n in names for c in columns if n.lower() in c.lower()), None)
    return out


def companion(path: str, suffix: str = "ZONE") -> str | None:
    """The zone file beside a values file, if there is one."""
    base = os.path.basename(path)
    other = os.path.join(os.path.dirname(path), base.replace("VALORI", suffix))
    return other if other != path and os.path.exists(other) else None


def zone_labels(zones: DataFrame, key: str = "LinkZona", label: str = "Zona_Descr") -> DataFrame:
    """``key, zona``: labels without quotes; one a key."""
    clean = F.trim(F.regexp_replace(label, "^'+|'+$", ""))
    return zones.select(F.col(key).alias(key), clean.alias("zona")).groupBy(key).agg(F.min("zona").alias("zona"))


def load_bands(values: DataFrame, labels: DataFrame | None, mapping: dict[str, str], scope: list[str], semester: str) -> DataFrame:
    """Bands of the areas in scope from a values file: Italian decimals, rows without bounds dropped, labels joined."""
    from pagliaio.functions.numbers import italian_decimal
    from pagliaio.functions.text import area_key

    col = lambda name: F.col(mapping[name]) if mapping.get(name) else F.lit(None).cast("string")
    rows = values.select(area_key(col("comune")).alias("comune"), col("zona_code").alias("zona_code"), col("link").alias("LinkZona"), col("tipologia").alias("tipologia"), col("stato").alias("stato"), italian_decimal(col("min")).alias("min_eur_m2"), italian_decimal(col("max")).alias("max_eur_m2"), col("basis").alias("surface_basis"), F.lit(semester).alias("semester"))
    rows = rows.where(F.col("comune").isin(*scope) & F.col("min_eur_m2").isNotNull() & F.col("max_eur_m2").isNotNull())
    if labels is not None:
        rows = rows.join(F.broadcast(labels), "LinkZona", "left")  # a zone file of a province
        return rows.withColumn("zona_descr", F.coalesce("zona", "zona_code")).drop("zona", "LinkZona")
    return rows.withColumn("zona_descr", F.col("zona_code")).drop("LinkZona")


_POLYGONS = "comune string, ord int, zona_code string, outer_ring array<struct<x:double,y:double>>, holes array<array<struct<x:double,y:double>>>"


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Polygons of zipped KML files: area from the document name before ``(``, code from ``CODZONA``, holes kept."""

    def ring(element) -> list[dict]:
        text = (element.findtext(".//{*}coordinates") or "").split()
        return [{"x": float(x), "y": float(y)} for x, y in (p.split(",")[:2] for p in text)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in sorted(n for n in z.namelist() if n.lower().endswith(".kml")):
                        root = ET.fromstring(z.read(name))
                        area = (root.findtext(".//{*}Document/{*}name") or "").split("(")[0].strip()
                        for k, mark in enumerate(root.iterfind(".//{*}Placemark")):
                            code = next((d.findtext("{*}value") or d.text for d in mark.iterfind(".//*[@name='CODZONA']")), None)
                            for polygon in mark.iterfind(".//{*}Polygon"):
                                outer = polygon.find("{*}outerBoundaryIs")
                                if code and outer is not None:
                                    rows.append((area, k, code.strip(), ring(outer), [ring(h) for h in polygon.iterfind("{*}innerBoundaryIs")]))
            yield pd.DataFrame(rows, columns=["comune", "ord", "zona_code", "outer_ring", "holes"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, _POLYGONS)


def read_side_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON side file by explicit schema; a missing file is an empty table."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).option("multiLine", True).json(path) if there else spark.createDataFrame([], schema)
