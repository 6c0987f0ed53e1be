"""Astronomy-shaped views of the driver's tables, in both engines, and the register of queries.

Views (``det``, ``gaia``, ``usno`` ...) are one list of expressions each, valid in both engines; only the time function
differs. Whole tables go in: there is no sampling or cap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T0 = "1704067200.0E0"
DET = f"""event_id as det_id; cast(floor(($us/1000000.0E0-{T0})/259200.0E0) as int) as epoch_id; $us/1000000.0E0 as obs_time; user_id as truth;
20.0E0+20.0E0*(user_id%50)+0.137E0*(event_id%11-5) as x; 20.0E0+20.0E0*floor(user_id/50)+0.137E0*(event_id%7-3) as y;
180.0E0+(20.0E0+20.0E0*(user_id%50)+0.137E0*(event_id%11-5))/3600.0E0 as ra; 30.0E0+(20.0E0+20.0E0*floor(user_id/50)+0.137E0*(event_id%7-3))/3600.0E0 as dec;
14.0E0+1.3E0*ln(1.0E0+value) as mag; 0.01E0+0.0031E0*(event_id%97) as err; 2.0E0+0.0131E0*(event_id%53) as fwhm; 1.0E0+0.0171E0*(event_id%31) as a;
(1.0E0+0.0171E0*(event_id%31))*(0.5E0+0.0137E0*(event_id%29)) as b; 1.0E0*((event_id*7)%180) as theta; cast(event_id%16 as int) as flags; 0.0113E0*(event_id%61) as ellipticity;
17.0E0+0.31E0*(event_id%13) as maglim; 0.011E0*(event_id%101) as ex2; 0.013E0*(event_id%89) as ey2; event_type as kind"""
STAR = """p_partkey as star_id; 20.0E0+20.0E0*(p_partkey%50) as sx; 20.0E0+20.0E0*floor(p_partkey/50) as sy; 180.0E0+(20.0E0+20.0E0*(p_partkey%50))/3600.0E0 as sra;
30.0E0+(20.0E0+20.0E0*floor(p_partkey/50))/3600.0E0 as sdec; case when p_partkey%10<>0 then 14.5E0+0.0171E0*(p_partkey%401) end as star_mag; 5.3E0*(p_partkey%17)-40.0E0 as pmra; 4.1E0*(p_partkey%23)-45.0E0 as pmdec"""
TYPES = "case event_id%5 when 0 then 'new' when 1 then 'brightening' when 2 then 'fading' when 3 then 'trail' else 'unknown' end"
GALAXY = "case event_id%3 when 0 then 'in_galaxy' when 1 then 'nuclear' else 'isolated' end"


def _exprs(text: str, us: str) -> list[str]:
    return [e.strip() for e in text.replace("$us", us).split(";")]


def _sql(text: str, table: str, where: str = "") -> str:
    return f"select {', '.join(_exprs(text, 'epoch_us(ts)'))} from {table}{' where ' + where if where else ''}"


WITH = {
    "det": _sql(DET, "events"),
    "gaia": _sql(STAR, "part", "p_partkey%3<>0"),
    "usno": _sql(STAR, "part", "p_partkey%4<>0"),
    "all_stars": _sql(STAR, "part"),
    "cand": f"select det.*, {TYPES.replace('event_id', 'det_id')} as candidate_type, {GALAXY.replace('event_id', 'det_id')} as galaxy_flag, 1.0857E0/err as snr_auto, b/a as axis_ratio, 0.37E0*(det_id%9)-1.3E0 as magnitude_difference, 0.011E0*(det_id%307) as quality from det where err < 1.091E0/5.0E0",
}


def with_views(*names: str) -> str:
    need = list(dict.fromkeys(n for x in names for n in (("det", "cand") if x == "cand" else (x,))))
    return "with recursive " + ", ".join(f"{n} as ({WITH[n]})" for n in need)


def det(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet").selectExpr(*_exprs(DET, "unix_micros(cast(ts as timestamp))"))


def stars(spark: SparkSession, d: str, lacking: int | None = None) -> DataFrame:
    """A reference catalogue; with ``lacking`` one that doesn't know each so manieth star, for what depends on unknown ones."""
    x = spark.read.parquet(f"{d}/part.parquet")
    return (x if lacking is None else x.where(F.col("p_partkey") % lacking != 0)).selectExpr(*_exprs(STAR, ""))


def cand(spark: SparkSession, d: str) -> DataFrame:
    x = det(spark, d).where(F.col("err") < 1.091 / 5.0)
    return x.selectExpr("*", f"{TYPES.replace('event_id', 'det_id')} as candidate_type", f"{GALAXY.replace('event_id', 'det_id')} as galaxy_flag", "1.0857E0/err as snr_auto", "b/a as axis_ratio", "0.37E0*(det_id%9)-1.3E0 as magnitude_difference", "0.011E0*(det_id%307) as quality")


def r(v: Column | str, digits: int = 5) -> Column:
    return F.round(v, digits)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add
