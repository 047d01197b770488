"""Parameters of a run: where the layers live, which day it is for, and how strict the checks are."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from hirelake.session import scale_conf


def required(settings: Mapping[str, str], name: str, default: str | None = None) -> str:
    """A setting, its default, or an error that names it."""
    value = settings.get(name, default)
    if value is None:
        raise ValueError(f"Required setting is missing: {name}")
    return value


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    schema: str = "public"

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}"


@dataclass(frozen=True)
class RunParams:
    """``bronze``, ``silver`` and ``gold`` are path prefixes on any file system that Spark reads."""

    bronze: str
    silver: str
    gold: str
    dt: str
    run_date: date
    run_name: str = "daily_postings"
    max_unknown_ratio: float = 0.80
    spark_conf: Mapping[str, str] = field(default_factory=dict)
    jdbc: JdbcTarget | None = None
    catalog: str | None = None  # database whose names show the latest silver tables

    @classmethod
    def from_settings(cls, settings: Mapping[str, str] | None = None) -> RunParams:
        """Build from a mapping (the process environment by default).

        Settings of an S3-compatible store, when present, become the matching ``spark.hadoop.fs.s3a`` options, and
        ``INPUT_BYTES`` sizes splits and shuffles; a day sizes them from its input's listing otherwise.
        """
        s = os.environ if settings is None else settings
        dt = required(s, "DS")
        conf = scale_conf(int(s["INPUT_BYTES"])) if "INPUT_BYTES" in s else {}
        if "S3_ENDPOINT" in s:
            conf |= {
                "spark.hadoop.fs.s3a.endpoint": s["S3_ENDPOINT"],
                "spark.hadoop.fs.s3a.access.key": required(s, "S3_ACCESS_KEY"),
                "spark.hadoop.fs.s3a.secret.key": required(s, "S3_SECRET_KEY"),
                "spark.hadoop.fs.s3a.path.style.access": "true",
                "spark.hadoop.fs.s3a.connection.ssl.enabled": required(s, "S3_SSL", "false"),
            }
        jdbc = None
        if "PG_HOST" in s:
            host, port, db = s["PG_HOST"], required(s, "PG_PORT", "5432"), required(s, "PG_DB")
            jdbc = JdbcTarget(
                url=f"jdbc:postgresql://{host}:{port}/{db}",
                user=required(s, "PG_USER"),
                password=required(s, "PG_PASSWORD"),
                schema=required(s, "PG_SCHEMA", "public"),
            )
        return cls(
            bronze=required(s, "BRONZE_PATH"),
            silver=required(s, "SILVER_PATH"),
            gold=required(s, "GOLD_PATH"),
            dt=dt,
            run_date=date.fromisoformat(required(s, "RUN_DATE", dt)),
            max_unknown_ratio=float(required(s, "DQ_MAX_UNKNOWN_RATIO", "0.80")),
            spark_conf=conf,
            jdbc=jdbc,
            catalog=s.get("CATALOG"),
        )
