"""Named steps, typed configuration and the error table of a reduction."""

from __future__ import annotations

import hashlib
import json
import re
import tomllib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Step = Callable[..., DataFrame]
STEPS: dict[str, Step] = {}


def step(name: str) -> Callable[[Step], Step]:
    """Registers a function (DataFrame, **arguments) -> DataFrame."""

    def put(f: Step) -> Step:
        STEPS[name] = f
        return f

    return put


@dataclass
class Config:
    """An ordered list of steps, and their arguments; a section named like a step wins over arguments in the list."""

    pipeline: list[tuple[str, dict]] = field(default_factory=list)

    @classmethod
    def loads(cls, text: str) -> Config:
        data = tomllib.loads(text)
        out = []
        for entry in data.get("pipeline", {}).get("steps", []):
            name, args = (entry, {}) if isinstance(entry, str) else (entry["name"], {k: v for k, v in entry.items() if k != "name"})
            section = data
            for part in name.split("."):
                section = section.get(part, {}) if isinstance(section, dict) else {}
            out.append((name, args | section))
        return cls(out)

    def name(self) -> str:
        """Twelve digits that change with the configuration."""
        return hashlib.sha256(json.dumps(self.pipeline, sort_keys=True).encode()).hexdigest()[:12]

    def apply(self, df: DataFrame) -> DataFrame:
        for name, args in self.pipeline:
            if name not in STEPS:
                raise KeyError(f"no step is called {name}")
            df.sparkSession.sparkContext.setJobDescription(name)
            df = df.transform(STEPS[name], **args)
        return df


def errors(df: DataFrame, key: str, checks: dict[str, object]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all checks (columns of booleans), and (key, step, message) of the others: a bad row stops no job."""
    failed = F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(m)) for m, c in checks.items()]), lambda m: m.isNotNull())
    rows = df.withColumn("_failed", failed)
    return rows.where(F.size("_failed") == 0).drop("_failed"), rows.where(F.size("_failed") > 0).select(key, F.lit("check").alias("step"), F.explode("_failed").alias("message"))


def run(config: Config, work: DataFrame, samples: DataFrame, checks: dict[str, object]) -> tuple[DataFrame, DataFrame]:
    """(result, errors) of a configuration over the samples of those observations of ``work`` that pass all checks; one job, whatever their number."""
    good, bad = errors(work, "obsid", checks)
    return config.apply(samples.join(good.select("obsid").distinct(), "obsid", "left_semi")), bad


#: The named kinds of map and the split that each stands for.
PRESETS: dict[str, dict[str, object]] = {"map": {"mode": "none"}, "map_per_feed": {"mode": "per_feed"}, "map_day_night": {"mode": "day_night", "threshold": 0.0}, "line_map": {"mode": "custom", "column": "ifreq"}}


def preset(df: DataFrame, name: str, pix: str, value: str, weight: str) -> DataFrame:
    """(split, pix, map, weight, hits): the maps of a named kind in one job."""
    if name not in PRESETS:
        raise ValueError(f"no kind of map is called {name}")
    return STEPS["Maps.Binned"](split_keys(df, **PRESETS[name]), keys=["split", pix], value=value, weight=weight)


def split_keys(df: DataFrame, mode: str, **how: object) -> DataFrame:
    """Adds ``split``, a key that map-making groups by: none, per_feed, day_night (sun altitude above a threshold), alternate_scans or custom (a column)."""
    if mode == "none":
        key = F.lit("all")
    elif mode == "per_feed":
        key = F.concat(F.lit("feed"), F.col("feed"))
    elif mode == "day_night":
        key = F.when(F.col("sun_altitude") > float(how.get("threshold", 0.0)), "day").otherwise("night")
    elif mode == "alternate_scans":
        key = F.when(F.col("scan") % 2 == 0, "even").otherwise("odd")
    elif mode == "custom":
        key = F.col(str(how["column"])).cast("string")
    else:
        raise ValueError(f"no split is called {mode}")
    return df.withColumn("split", key)


def call(text: str) -> tuple[str, str, dict[str, object]]:
    """(package, module, arguments) of ``Package.Module(name=value, ...)``.

    Values are quoted texts, lists of texts, True or False, whole or other numbers, else the text as it stands. A text
    of another form is an error.
    """
    whole = re.fullmatch(r"([^()]*)\.([^().]+)\(([^()]*)\)", text)
    if not whole:
        raise ValueError(f"not of the form Package.Module(name=value, ...): {text}")

    def value(v: str) -> object:
        if v.startswith("["):
            return [x.replace('"', "").strip() for x in v[1:-1].split(",")]
        if len(v) > 1 and v[0] == v[-1] and v[0] in "\"'":
            return v[1:-1]
        if v in ("True", "False"):
            return v == "True"
        for kind in (int, float):
            try:
                return kind(v)
            except ValueError:
                continue
        return v

    arguments = {}
    for pair in whole[3].split(", ") if whole[3] else []:
        name, equals, v = pair.partition("=")
        if not equals or not v or "=" in v:
            raise ValueError(f"not name=value: {pair}")
        arguments[name.strip()] = value(v)
    return whole[1], whole[2], arguments
