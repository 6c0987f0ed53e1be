"""Registered queries of fields, frames, calibration, images and reports, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import identity as ident
from ..functions import photometry as phot
from ..functions.tables import shared_dir
from ..operators import epochs, features, images, lightcurve, spatial
from ..sources import catalogs
from . import viewer
from .views import cand, det, query, r, stars, with_views

# --- gates and headers ---------------------------------------------------------------------------------------------


@query(f"{with_views('det')} select det_id from det where x*1.1E0-40 >= -10 and x*1.1E0-40 < 1000+10 and y-30 >= -10 and y-30 < 350+10")
def reference_frame_bounds(spark, d):
    return det(spark, d).where(features.in_reference_frame(F.col("x") * 1.1 - 40, F.col("y") - 30, 1000.0, 350.0)).select("det_id")


@query(f"{with_views('det')} select det_id from det where obs_time+(20.0E0+det_id%50)/2-1704067200.0E0 <= 43200")
def early_limit(spark, d):
    return det(spark, d).where(features.early_enough(F.col("obs_time"), 20.0 + F.col("det_id") % 50, 1704067200.0)).select("det_id")


@query("select event_id as det_id, case when event_id%7=0 then 3.0E0 when event_id%11=0 then 3.0E0 when event_id%13=0 then 3.0E0 else 1.5E0+0.1E0*(event_id%40) end as fwhm from events")
def fwhm_guard(spark, d):
    x = spark.read.parquet(f"{d}/events.parquet").selectExpr("event_id as det_id", "case when event_id%7=0 then 0.0E0 when event_id%11=0 then double('NaN') when event_id%13=0 then double('Infinity') else 1.5E0+0.1E0*(event_id%40) end as v")
    return x.select("det_id", features.fwhm_or_default(F.col("v")).alias("fwhm"))


@query(f"{with_views('det')} select det_id, round(case when det_id%3=0 then 2460000.5E0+det_id when det_id%3=1 then 60000.0E0+det_id+2400000.5E0 end, 4) as jd, round(obs_time+(case when det_id%4=0 then 0 else 10.0E0+det_id%50 end)/2, 3) as middle from det")
def julian_choice(spark, d):
    k = F.col("det_id")
    jd = geo.julian_date(F.when(k % 3 == 0, 2460000.5 + k), F.when(k % 3 <= 1, 60000.0 + k))
    return det(spark, d).select("det_id", r(jd, 4).alias("jd"), r(geo.exposure_middle(F.col("obs_time"), F.when(k % 4 != 0, 10.0 + k % 50)), 3).alias("middle"))


@query(f"{with_views('det')} select det_id, round(case when det_id%3=0 then 3600*sqrt(abs((0.0001E0+0.000001E0*(det_id%9))*-0.0002E0)) when det_id%3=1 then 3600*abs(-0.0003E0) else 0.33E0 end, 6) as scale from det")
def plate_scales(spark, d):
    k = F.col("det_id")
    cd11, cd22, cdelt = F.when(k % 3 == 0, 0.0001 + 0.000001 * (k % 9)).otherwise(0.0), F.when(k % 3 == 0, -0.0002).otherwise(0.0), F.when(k % 3 == 1, -0.0003).otherwise(0.0)
    return det(spark, d).select("det_id", r(geo.plate_scale(cd11, cd22, cdelt), 6).alias("scale"))


@query(f"""{with_views('det', 'all_stars')} select det_id from det where not (x < 25 or y < 25 or x > 985 or y > 600) and err < 1.091E0/5.0E0
and not exists (select 1 from all_stars where star_mag is not null and abs(x-sx)<=1 and abs(y-sy)<=1 and sqrt((x-sx)*(x-sx)+(y-sy)*(y-sy))<=1.0E0 and abs(star_mag-mag) <= 5.0E0*err)""")
def legacy_candidates(spark, d):
    return features.legacy_candidates(det(spark, d), stars(spark, d), 1.0, 5.0, 1010.0, 625.0, 25.0).select("det_id")


@query(f"{with_views('det')} select det_id, case when det_id%5=0 then mag else mag+25.5E0 end as mag, case when det_id%5=0 then err else err+0.001E0 end as err from (select det_id, round(mag, 6) as mag, round(err, 6) as err from det) where true")
def diff_calibration(spark, d):
    own = F.col("det_id") % 5 == 0
    x = det(spark, d).select("det_id", r("mag", 6).alias("m"), r("err", 6).alias("e"))
    m, e = phot.calibrated(F.when(own, F.col("m")), F.when(own, F.col("e")), F.col("m"), F.col("e") + 0.001, F.lit(25.5))
    return x.select("det_id", m.alias("mag"), e.alias("err"))


@query(f"""{with_views('det', 'all_stars')}, z as (select epoch_id, star_mag-mag as z from det join all_stars on abs(x-sx)<=1 and abs(y-sy)<=1 and sqrt((x-sx)*(x-sx)+(y-sy)*(y-sy))<=1.0E0 where star_mag is not null),
m as (select epoch_id, median(z) as m from z group by epoch_id), s as (select epoch_id, median(abs(z-m))/0.67E0 as s from z join m using (epoch_id) group by epoch_id),
g as (select epoch_id, z from z join m using (epoch_id) join s using (epoch_id) where abs(z-m) <= 1.5E0*s)
select epoch_id, count(*) as n_good, round(median(z), 5) as zero_point, round(case when count(*)>1 then stddev_pop(z)/sqrt(count(*)-1) end, 6) as zero_error from g group by epoch_id""")
def zero_points(spark, d):
    near = spatial.radius_join(det(spark, d).select("epoch_id", "x", "y", "mag"), stars(spark, d).select("sx", "sy", "star_mag"), 1.0, right_on=("sx", "sy"))
    return phot.zero_point(near, "epoch_id", 1.5).select("epoch_id", "n_good", r("zero_point").alias("zero_point"), r("zero_error", 6).alias("zero_error"))


_MODEL = {"Z": 24.3, "PA": 0.11, "P2C": 0.02, "PXY": -0.03, "PR": 0.004, "PND": 0.001, "SX": 0.01, "SY": -0.02, "SXY": 0.005, "XC": 0.6, "SC": 0.3, "GA": 0.05, "GW": 0.2, "EA": -0.01, "EW": 2.0, "RS": 0.003, "RO": 0.4, "RC": 0.1, "PX:2": 0.07}


@query(f"""{with_views('det')}, m as (select det_id, -2.5E0*log10((pow(10.0E0,-0.4E0*mag)+0.01E0)/10000.0E0) as n, 1.0E0+0.01E0*(det_id%60) as air, x/1000 as u, y/1000 as v, 0.01E0*(det_id%70) as c1, 0.02E0*(det_id%30)-0.1E0 as c2, 0.03E0 as c3, x-floor(x) as fx, y-floor(y) as fy, det_id%3 as im from det)
select det_id, round(n+14.3E0+0.11E0*air+0.02E0*c1*c1-0.03E0*u*v+0.004E0*(u*u+v*v)+0.001E0*n*c2+0.01E0*sin(pi()*fx)-0.02E0*sin(pi()*fy)+0.005E0*sin(pi()*fx)*sin(pi()*fy)+0.6E0*c2
+0.3E0*((1-sin(0.3E0*pi()))/2*c1+(1+sin(0.3E0*pi()))/2*c2)+0.05E0*exp(-(u*u+v*v)*25/pow(10.0E0,0.2E0))-0.01E0*(exp(sqrt((u*u+v*v)/2))/(sqrt((u*u+v*v)/2)+1)-1)+0.003E0*(-n-0.4E0)/(1+0.1E0*(-n-0.4E0)*(-n-0.4E0)+1e-10)+(case when im=1 then 0.07E0*u else 0 end), 5) as mag from m""")
def fitted_response(spark, d):
    k = F.col("det_id")
    colours = [0.01 * (k % 70), 0.02 * (k % 30) - 0.1, F.lit(0.03), F.lit(0.0)]
    m = phot.fitted_model(_MODEL, F.col("mag"), 1.0 + 0.01 * (k % 60), F.col("x") / 1000, F.col("y") / 1000, colours, F.col("x"), F.col("y"), k % 3)
    return det(spark, d).select("det_id", r(m).alias("mag"))


@query("""with f as (select n_nationkey as frame, 256+64*(n_nationkey%5) as w, 192+32*(n_nationkey%7) as h from nation), a as (select *, unnest(range(0, w, 64)) as px from f), p as (select *, unnest(range(0, h, 64)) as py from a),
q as (select *, (px-w/2.0E0)/1024.0E0 as u, (py-h/2.0E0)/1024.0E0 as v from p)
select frame, px, py, round(0.2E0*u-0.1E0*u*v+0.05E0*(u*u+v*v)+0.03E0*exp(-(u*u+v*v)*25/pow(10.0E0,-0.5E0)), 6)+0 as flat from q""")
def flat_mesh(spark, d):
    frames = spark.read.parquet(f"{d}/nation.parquet").selectExpr("n_nationkey as frame", "256+64*(n_nationkey%5) as width", "192+32*(n_nationkey%7) as height")
    x = phot.flat_mesh(frames, "frame", {"Z": 25.0, "PX": 0.2, "PXY": -0.1, "PR": 0.05, "GA": 0.03, "GW": -0.5, "PC": 3.0}, 64, 1024.0)
    return x.select("frame", "px", "py", (r("flat", 6) + 0).alias("flat"))


@query("""select l_orderkey as k, l_linenumber as n, round(2.5E0/(ln(10)*l_quantity*sqrt(l_extendedprice)), 8) as err, case when l_returnflag='A' then 0.01E0 when l_returnflag='R' then 0.10E0 when l_linestatus='F' then 0.03E0 else 0.02E0 end as floor from lineitem""")
def flux_errors(spark, d):
    x = spark.read.parquet(f"{d}/lineitem.parquet")
    kind = F.when(F.col("l_returnflag") == "A", "my_GAIA_dr3").when(F.col("l_returnflag") == "R", "usno@somewhere").when(F.col("l_linestatus") == "F", "Atlas").when(F.col("l_linenumber") == 1, "panstarrs").otherwise("sdss")
    return x.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), r(phot.ivar_error(F.col("l_quantity"), F.col("l_extendedprice")), 8).alias("err"), phot.systematic_error(kind).alias("floor"))


# --- sources, frames, templates ------------------------------------------------------------------------------------


_SURVEY = "select p_partkey as id, (359.0E0+0.002E0*(p_partkey%1000)) - 360*floor((359.0E0+0.002E0*(p_partkey%1000))/360) as ra, 30.0E0+0.001E0*(p_partkey%777) as dec, 0.5E0*(p_partkey%40)-1 as flux_g, 0.4E0*(p_partkey%50)-1 as flux_r, 0.3E0*(p_partkey%60) as flux_z, 1.0E0*(p_partkey%9) as ivar, p_partkey%5 as nobs_r from part"


@query(f"""with s as ({_SURVEY}), w as (select sqrt(0.5E0*0.5E0+0.4E0*0.4E0)/2 as rad), b as (select rad, rad/cos(radians(30.2E0)) as ram from w)
select round(ra, 6) as radeg, round(dec, 6) as decdeg, round(case when flux_r>0 then 22.5E0-2.5E0*log10(flux_r) end, 5) as "Sloan_r", round(case when flux_r>0 and ivar>0 then 2.5E0/(ln(10)*flux_r*sqrt(ivar)) end, 6) as "Sloan_r_err", round(case when flux_g>0 then 22.5E0-2.5E0*log10(flux_g) end, 5) as "Sloan_g"
from s, b where (ra >= 0.1E0-ram+360 or ra <= 0.1E0+ram) and dec between 30.2E0-rad and 30.2E0+rad and flux_r > pow(10.0E0, (22.5E0-21.5E0)/2.5E0) and nobs_r > 0""")
def survey_region(spark, d):
    t = spark.read.parquet(f"{d}/part.parquet").selectExpr("pmod(359.0E0+0.002E0*(p_partkey%1000), 360.0E0) as ra", "30.0E0+0.001E0*(p_partkey%777) as dec", "0.5E0*(p_partkey%40)-1 as flux_g", "0.4E0*(p_partkey%50)-1 as flux_r", "0.3E0*(p_partkey%60) as flux_z", "1.0E0*(p_partkey%9) as flux_ivar_r", "p_partkey%5 as nobs_r").withColumns({"flux_ivar_g": F.col("flux_ivar_r"), "flux_ivar_z": F.col("flux_ivar_r")})
    x = catalogs.reference_stars(t, catalogs.catalog("legacysurvey"), 0.1, 30.2, 0.5, 0.4, 21.5)
    return x.select(r("radeg", 6).alias("radeg"), r("decdeg", 6).alias("decdeg"), r("Sloan_r").alias("Sloan_r"), r("Sloan_r_err", 6).alias("Sloan_r_err"), r("Sloan_g").alias("Sloan_g"))


_CANDS = "select user_id as cand_id, 20.0E0+20.0E0*(user_id%50) as cx, 20.0E0+20.0E0*floor(user_id/50) as cy from (select distinct user_id from events) u"


@query(f"{with_views('det')}, k as ({_CANDS}) select cand_id, epoch_id, string_agg(cast(det_id as varchar), ',' order by det_id) as det_ids from k join det on abs(x-cx)<=0.6E0 and abs(y-cy)<=0.6E0 and sqrt((x-cx)*(x-cx)+(y-cy)*(y-cy))<=0.5E0 group by cand_id, epoch_id")
def image_matches(spark, d):
    k = spark.read.parquet(f"{d}/events.parquet").select("user_id").distinct().selectExpr("user_id as cand_id", "20.0E0+20.0E0*(user_id%50) as cx", "20.0E0+20.0E0*floor(user_id/50) as cy")
    x = spatial.image_matches(k, det(spark, d), 0.5)
    return x.select("cand_id", "epoch_id", F.concat_ws(",", F.transform("det_ids", lambda v: v.cast("string"))).alias("det_ids"))


@query()
def source_list(spark, d):
    from ..operators.graph import source_list as grow

    return grow(det(spark, d), 0.5)


@query()
def source_list_stream(spark, d):
    """The same list from a stream, an exposure at a time."""
    from ..streaming.source_list import decisions, grow

    top = f"{shared_dir(spark)}/sources-{uuid.uuid4().hex}"
    x = det(spark, d).select("det_id", F.col("epoch_id").cast("long").alias("epoch_id"), "ra", "dec")
    x.withColumn("exposure", F.col("epoch_id")).write.partitionBy("exposure").parquet(f"{top}/exposures")
    for e in sorted(row[0] for row in x.select("epoch_id").distinct().collect()):
        # a folder is one exposure, so that each is read once
        spark.read.schema(x.schema).parquet(f"{top}/exposures/exposure={e}").coalesce(1).write.mode("append").parquet(f"{top}/arrivals")
    stream = grow(spark, f"{top}/arrivals", top, 0.5)
    try:
        stream.processAllAvailable()
    finally:
        stream.stop()
    return decisions(spark, top)


_FRAMES = "select o_orderkey as position, o_custkey%41 as grp, 'img_'||lpad(cast(o_orderkey as varchar), 9, '0')||'_'||(case when o_orderkey%5=0 then 'dark' when o_orderkey%3=0 then 'exp'||cast(o_orderkey%90 as varchar) else cast(o_orderkey%60 as varchar)||'sec' end) as name, cast(o_totalprice*1000 as bigint) as size from orders"


@query(f"""with f as ({_FRAMES}), a as (select *, row_number() over w - 1 as i, count(*) over (partition by grp) as n from f window w as (partition by grp order by position, name)),
b as (select *, coalesce(try_cast(coalesce(nullif(regexp_extract(name, '(\\d+)s[^ec]', 1), ''), nullif(regexp_extract(name, 'exp(\\d+)', 1), ''), nullif(regexp_extract(name, '(\\d+)sec', 1), ''), nullif(regexp_extract(name, '_(\\d+)_', 1), '')) as double), 0)/100 + size/104857600.0E0 - (case when name like '%dark%' then 10 else 0 end) + 0.5E0*(1-abs(i-n/2.0E0)/(n/2.0E0)) as score from a),
c as (select *, first_value(case when score>-1 then i end ignore nulls) over (partition by grp order by score desc, i rows between unbounded preceding and unbounded following) as best from b),
e as (select *, (i=0 or i=n-1 or i=coalesce(best, 0)) as fixed from c), g as (select *, sum(fixed::int) over (partition by grp) as held, row_number() over (partition by grp order by fixed, i)-1 as rk from e),
h as (select *, greatest(1, (n-held)//greatest(8-held, 1)) as step from g)
select grp, position from h where n<=8 or fixed or (8-held>0 and rk%step=0 and rk/step<8-held)""")
def frame_sampling(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet").selectExpr("o_orderkey as position", "o_custkey%41 as grp", "concat('img_', lpad(cast(o_orderkey as string), 9, '0'), '_', case when o_orderkey%5=0 then 'dark' when o_orderkey%3=0 then concat('exp', o_orderkey%90) else concat(o_orderkey%60, 'sec') end) as name", "cast(o_totalprice*1000 as bigint) as size")
    return epochs.sample_frames(o, "grp", 8).select("grp", "position")


@query("""with s as (select o_orderkey as epoch_id, cast(o_custkey%7 as varchar) as field, o_orderkey%4 as k from orders), t as (select field, max(epoch_id) as template_id from s group by field)
select epoch_id, cast(template_id as varchar) as template_id from s join t using (field) where epoch_id <> template_id and k<>0""")
def missing_differences(spark, d):
    s = spark.read.parquet(f"{d}/orders.parquet").selectExpr("o_orderkey as epoch_id", "cast(o_custkey%7 as string) as field", "o_orderkey%4 as k")
    return epochs.missing_differences(s, s.where("k = 0").select("epoch_id"), s.groupBy("field").agg(F.max("epoch_id").alias("template_id")))


@query("""with f as (select event_id, 180.0E0+0.013E0*(user_id%50) as ra, 30.0E0+0.017E0*(user_id%7) as dec, 'r' as band from events), t as (select p_partkey as tile, 180.0E0+0.02E0*(p_partkey%40) as ra, 30.0E0+0.02E0*(p_partkey%3) as dec, case when p_partkey%3=0 then 'g' else 'r' end as band, p_size as made from part),
k as (select *, round_even(ra/0.02E0, 0) as a, round_even(dec/0.02E0, 0) as b from t), n as (select a, b, band, arg_max(tile, struct_pack(m := made, t := tile)) as tile from k group by a, b, band)
select event_id, tile from f left join n on n.a=round_even(ra/0.02E0, 0) and n.b=round_even(dec/0.02E0, 0) and n.band=f.band""")
def survey_templates(spark, d):
    f = spark.read.parquet(f"{d}/events.parquet").selectExpr("event_id", "180.0E0+0.013E0*(user_id%50) as ra", "30.0E0+0.017E0*(user_id%7) as dec", "'r' as band")
    t = spark.read.parquet(f"{d}/part.parquet").selectExpr("p_partkey as tile", "180.0E0+0.02E0*(p_partkey%40) as ra", "30.0E0+0.02E0*(p_partkey%3) as dec", "case when p_partkey%3=0 then 'g' else 'r' end as band", "p_size as made")
    return epochs.templates_by_cell(f, t).select("event_id", "tile")


@query(f"{with_views('det')} select det_id, round((obs_time-min(obs_time) over (partition by truth))/3600, 5) as hours from det")
def hours_since_first(spark, d):
    return lightcurve.hours_since_first(det(spark, d), "truth").select("det_id", r("hours").alias("hours"))


@query(f"""{with_views('det')}, m as (select truth, median(obs_time) as mid, count(*) as n from det group by truth), a as (select det.truth, det_id, n, row_number() over (partition by det.truth order by abs(obs_time-mid), det_id) as k, row_number() over (partition by det.truth order by obs_time, det_id)-1 as i from det join m using (truth))
select t.truth as gid, t.det_id as by_time, p.det_id as by_place from (select truth, det_id from a where k=1) t join (select truth, det_id from a where i=n//2) p using (truth)""")
def reference_points(spark, d):
    x = det(spark, d).withColumnRenamed("truth", "gid")
    named = lambda by, name: lightcurve.reference_points(x, by=by).join(x, "gid").where("r.obs_time = obs_time and r.ra = ra and r.dec = dec").groupBy("gid").agg(F.min("det_id").alias(name))
    return named("time", "by_time").join(named("middle", "by_place"), "gid")


# --- images --------------------------------------------------------------------------------------------------------


@query("with p as (select x.vec_id, generate_subscripts(x.embedding, 1) as i, x.embedding as a, t.embedding as b from embeddings x join embeddings t on t.vec_id=(x.vec_id//10)*10), v as (select vec_id, case when i%9=0 then null else a[i]::double-b[i] end as dv from p) select vec_id, count(dv) as n, round(sum(dv), 4) as total from v group by vec_id")
def masked_difference(spark, d):
    x = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding", (F.floor(F.col("vec_id") / 10) * 10).alias("t"))
    hole = F.transform("embedding", lambda v, i: F.when((i + 1) % 9 == 0, F.lit(float("nan"))).otherwise(v.cast("double")))
    both = x.select("vec_id", "t", hole.alias("science")).join(x.select(F.col("vec_id").alias("t"), F.col("embedding").alias("template")), "t")
    y = both.select("vec_id", F.filter(images.subtract("masked", F.col("science"), F.col("template")), lambda v: ~F.isnan(v)).alias("dv"))
    return y.select("vec_id", F.size("dv").cast("long").alias("n"), r(F.aggregate("dv", F.lit(0.0), lambda a, b: a + b), 4).alias("total"))


@query("with p as (select vec_id, embedding as e, vec_id%7 as x0, vec_id%6 as y0, dx, dy from embeddings, (select unnest(range(4)) as dx) a, (select unnest(range(3)) as dy) b) select vec_id, count(*) filter (where x0+dx<8 and y0+dy<8) as n, round(sum(case when x0+dx<8 and y0+dy<8 then e[(y0+dy)*8+x0+dx+1]::double end), 5) as total from p group by vec_id")
def image_section(spark, d):
    x = spark.read.parquet(f"{d}/embeddings.parquet")
    cut = images.section(F.col("embedding"), 8, (F.col("vec_id") % 7).cast("int"), (F.col("vec_id") % 6).cast("int"), 4, 3)
    y = x.select("vec_id", F.filter(cut, lambda v: v.isNotNull()).alias("v"))
    return y.select("vec_id", F.size("v").cast("long").alias("n"), r(F.aggregate("v", F.lit(0.0), lambda a, b: a + b)).alias("total"))


@query("""with p as (select vec_id, unnest(embedding)::double as v from embeddings), l as (select vec_id, quantile_cont(v, 0.01) as lo, quantile_cont(v, 0.99) as hi from p group by vec_id)
select vec_id, round(min(lo), 5) as low, round(min(hi), 5) as high, cast(sum(round_even(255*pow(least(greatest((v-lo)/(hi-lo), 0), 1), 0.8E0), 0)) as bigint) as total from p join l using (vec_id) group by vec_id""")
def stretched_stamps(spark, d):
    e = spark.read.parquet(f"{d}/embeddings.parquet")
    lv = images.levels(images.pixels(e, "vec_id", "embedding", 8), "vec_id")
    grey = images.stretched(F.transform("embedding", lambda v: v.cast("double")), F.col("low"), F.col("high"), 0.8)
    x = e.join(lv, "vec_id").select("vec_id", "low", "high", grey.alias("g"))
    return x.select("vec_id", r("low").alias("low"), r("high").alias("high"), F.aggregate("g", F.lit(0).cast("long"), lambda a, b: a + b).alias("total"))


@query("""select o_orderkey as epoch_id, case when o_orderkey%2=0 then o_orderpriority else 'own' end as filter, o_orderstatus as object, 'epoch '||cast(o_custkey as varchar) as template from orders""")
def merged_headers(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    own = F.create_map(F.lit("FILTER"), F.lit("own"), F.lit("OBJECT"), F.col("o_orderstatus"), F.lit("TEMPLATE"), F.lit("old"))
    sibling = F.create_map(F.lit("FILTER"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")), F.lit("OTHER"), F.lit("left out"))
    h = images.merged_header(own, sibling, F.concat(F.lit("epoch "), F.col("o_custkey").cast("string")), ["FILTER", "FIELD"])
    x = o.select(F.col("o_orderkey").alias("epoch_id"), h.alias("h"))
    return x.select("epoch_id", F.col("h")["FILTER"].alias("filter"), F.col("h")["OBJECT"].alias("object"), F.col("h")["TEMPLATE"].alias("template"))


@query(f"{with_views('det')}, e as (select epoch_id, avg(fwhm)/2.35E0 as s from det group by epoch_id), i as (select epoch_id, i, exp(-(pow(i//9-4, 2)+pow(i%9-4, 2))/(2*s*s)) as v from e, range(81) t(i)) select epoch_id, i::int as i, round(v/sum(v) over (partition by epoch_id), 7) as v from i")
def psf_stamp(spark, d):
    x = det(spark, d).groupBy("epoch_id").agg((F.avg("fwhm") / 2.35).alias("s"))
    return x.select("epoch_id", F.posexplode(images.psf_stamp(F.col("s"), 4)).alias("i", "v")).select("epoch_id", "i", r("v", 7).alias("v"))


# --- reports -------------------------------------------------------------------------------------------------------


@query(f"{with_views('det')} select truth as gid, kind as band, case when det_id%3=0 then 'a' else 'b' end as survey, string_agg(cast(det_id as varchar), ',' order by obs_time, det_id) filter (where det_id%7<>0) as detections, count(*) filter (where det_id%7=0) as n_limits from det group by all")
def band_series(spark, d):
    x = det(spark, d).select(F.col("truth").alias("gid"), F.col("kind").alias("band"), F.when(F.col("det_id") % 3 == 0, "a").otherwise("b").alias("survey"), F.col("obs_time").alias("mjd"), F.col("det_id").cast("double").alias("mag"), F.col("err").alias("mag_err"), (F.col("det_id") % 7 == 0).alias("ulim"))
    y = viewer.band_series(x)
    ids = F.concat_ws(",", F.transform("detections", lambda p: p["mag"].cast("long").cast("string")))
    return y.select("gid", "band", "survey", F.nullif(ids, F.lit("")).alias("detections"), F.size("limits").cast("long").alias("n_limits"))


@query(f"{with_views('det')} select truth as transient_id, count(*) as n_detections, count(distinct epoch_id) as n_epochs, round((max(obs_time)-min(obs_time))/3600, 5) as time_span_hours from det group by truth")
def curve_summary(spark, d):
    x = viewer.curve_summary(det(spark, d).withColumnRenamed("truth", "transient_id"))
    return x.select("transient_id", "n_detections", "n_epochs", r("time_span_hours").alias("time_span_hours"))


@query(f"{with_views('cand')}, t as (select truth, max(quality) as q from cand group by truth order by q desc, truth limit 32) select truth as gid, det_id from cand join t using (truth)")
def best_curves(spark, d):
    x = cand(spark, d).withColumnRenamed("truth", "gid")
    return viewer.best_curves(x.groupBy("gid").agg(F.max("quality").alias("quality_score")), x, 32, "gid").select("gid", "det_id")


@query(f"""{with_views('cand')} select det_id, '{{"candidate_type":"'||candidate_type||'","galaxy_sep_arcsec":'||(case when det_id%3=0 then 'null' else cast(det_id as varchar)||'.0' end)||',"tns_name":'||(case when det_id%5=0 then 'null' else '"AT'||cast(det_id as varchar)||'"' end)||',"FLAGS":'||cast(flags as varchar)||'.0}}' as report from cand""")
def report_lines(spark, d):
    k = F.col("det_id")
    x = cand(spark, d).select("det_id", "candidate_type", F.when(k % 3 == 0, float("nan")).otherwise(k.cast("double")).alias("galaxy_sep_arcsec"), F.when(k % 5 != 0, F.concat(F.lit("AT"), k.cast("string"))).alias("tns_name"), "flags", F.lit("x").alias("other"))
    return viewer.report_rows(x)


@query(f"""{with_views('cand')}, t as (select truth, max(quality) as q from cand group by truth order by q desc, truth limit 50)
select truth as gid, count(*) as n_points, string_agg(cast(det_id as varchar), ',' order by obs_time, det_id) as det_ids from cand join t using (truth) where mag>0 and err>0 group by truth""")
def nested_candidates(spark, d):
    x = cand(spark, d).withColumnRenamed("truth", "gid")
    y = viewer.nested_json(x.groupBy("gid").agg(F.max("quality").alias("quality_score")), x, 50)
    got = F.from_json("value", "struct<lightcurve:struct<n_points:bigint,points:array<struct<det_id:bigint>>>>")
    return y.select("gid", got.alias("j")).select("gid", F.col("j.lightcurve.n_points").alias("n_points"), F.concat_ws(",", F.transform("j.lightcurve.points", lambda p: p["det_id"].cast("string"))).alias("det_ids"))


@query(f"{with_views('det')}, g as (select truth, min(mag) filter (where err<0.02E0) as a, max(mag) filter (where err<0.02E0) as b from det group by truth) select truth as gid, round(coalesce(a-0.5E0, 14), 5) as top, round(coalesce(b+1, 22), 5) as bottom from g")
def axis_ranges(spark, d):
    x = det(spark, d).withColumnRenamed("truth", "gid")
    y = viewer.axis_range(x.where("err < 0.02E0"), groups=x)
    return y.select("gid", r("top").alias("top"), r("bottom").alias("bottom"))


@query("""with c as (select doc_id, case when doc_id%3=0 then 'NGC '||source end as object, case when doc_id%4=0 then '*' when doc_id%4=1 then lang end as target, case when doc_id%5<>0 then 'sib-'||lang end as sib from documents),
s as (select doc_id, nullif(trim(regexp_replace(coalesce(nullif(object, ''), nullif(target, '')), '[^a-zA-Z0-9_]', '_', 'g'), '_'), '') as own, nullif(trim(regexp_replace(sib, '[^a-zA-Z0-9_]', '_', 'g'), '_'), '') as sib from c)
select doc_id, coalesce(own, sib, 'f'||cast(doc_id as varchar)) as campaign from s""")
def campaign_ids(spark, d):
    x = spark.read.parquet(f"{d}/documents.parquet")
    k = F.col("doc_id")
    own = [F.when(k % 3 == 0, F.concat(F.lit("NGC "), F.col("source"))), F.when(k % 4 == 0, "*").when(k % 4 == 1, F.col("lang"))]
    got = ident.campaign_id(own, [F.when(k % 5 != 0, F.concat(F.lit("sib-"), F.col("lang")))], F.concat(F.lit("/a/b_c/f"), k.cast("string"), F.lit(".fits")))
    return x.select("doc_id", got.alias("campaign"))


@query(r"""with n as (select doc_id as k, 'x20240101-'||cast(doc_id as varchar)||(case doc_id%4 when 0 then '_exp30' when 1 then '_45sec' when 2 then '_60s_' else '_7_' end) as n, substr(coalesce(text, ''), 1, 5+(doc_id%90)::int) as c from documents),
s as (select k, n, trim(regexp_replace(regexp_replace(c, '[^a-zA-Z0-9_\-.]', '_', 'g'), '_+', '_', 'g'), '_.') as safe, c from n), i as (select k, n, case when safe='' then 'cand_'||substr(md5(c), 1, 5) else safe end as nm from s)
select k, case when length(nm)>50 then substr(nm, 1, 44)||'_'||substr(md5(nm), 1, 5) else nm end as cand, '20240101' as night, case k%4 when 0 then 30.0E0 when 1 then 45.0E0 when 2 then 60.0E0 else 7.0E0 end as seconds from i""")
def names_and_ids(spark, d):
    x = spark.read.parquet(f"{d}/documents.parquet")
    k = F.col("doc_id")
    n = F.concat(F.lit("x20240101-"), k.cast("string"), F.when(k % 4 == 0, "_exp30").when(k % 4 == 1, "_45sec").when(k % 4 == 2, "_60s_").otherwise("_7_"))
    return x.select(k.alias("k"), ident.candidate_id(F.substring(F.coalesce("text", F.lit("")), F.lit(1), (5 + k % 90).cast("int"))).alias("cand"), ident.date_from_name(n).alias("night"), ident.exposure_from_name(n).alias("seconds"))


@query(f"{with_views('det')} select det_id, case when det_id%3=0 then 0 else flags end as flags, 0.0E0 as err, case when det_id%4=0 then 3.0E0 else round(fwhm, 6) end as fwhm, cast(null as double) as theta from det")
def conformed_columns(spark, d):
    from pyspark.sql.types import StructType

    from ..sources.tables import DEFAULTS, conform

    x = det(spark, d).select("det_id", F.when(F.col("det_id") % 3 != 0, F.col("flags")).alias("flags"), F.when(F.col("det_id") % 4 != 0, r("fwhm", 6)).alias("fwhm"))
    return conform(x, StructType.fromDDL("det_id bigint, flags int, err double, fwhm double, theta double"), DEFAULTS)


@query(f"{with_views('det')} select det_id from det where (case when det_id%10=0 then -1.0E0 when det_id%10=1 then 361.0E0 else ra end) between 0 and 360 and (case when det_id%7=0 then 91.0E0 else dec end) between -90 and 90 and det_id%11<>0")
def valid_coordinates(spark, d):
    from ..operators.cluster import valid_positions

    k = F.col("det_id")
    ra = F.when(k % 11 == 0, float("nan")).when(k % 10 == 0, -1.0).when(k % 10 == 1, 361.0).otherwise(F.col("ra"))
    x = det(spark, d).select("det_id", ra.alias("ra"), F.when(k % 7 == 0, 91.0).otherwise(F.col("dec")).alias("dec"))
    return valid_positions(x).select("det_id")


@query(f"""with d as (select event_id as det_id, event_id%40 as epoch_id from events), h as (select epoch_id, 1700000000.0E0+1000*epoch_id as c, case when epoch_id%5=0 then null else 30.0E0+epoch_id end as e from (select distinct epoch_id from d) t)
select det_id, round(c+coalesce(e, 0)/2, 3) as obs_time, round((c+coalesce(e, 0)/2)/86400+40587.0E0, 6) as mjd, case when epoch_id%3=0 then 'unknown' else 'f'||cast(epoch_id as varchar) end as source_file from d join h using (epoch_id)""")
def annotated_epochs(spark, d):
    x = spark.read.parquet(f"{d}/events.parquet").selectExpr("event_id as det_id", "event_id%40 as epoch_id")
    h = x.select("epoch_id").distinct().selectExpr("epoch_id", "1700000000.0E0+1000*epoch_id as ctime", "case when epoch_id%5<>0 then 30.0E0+epoch_id end as exptime", "case when epoch_id%3<>0 then concat('f', epoch_id) end as filename")
    return epochs.annotate(x, h).select("det_id", r("obs_time", 3).alias("obs_time"), r("mjd", 6).alias("mjd"), "source_file")


@query(f"""{with_views('det')}, q as (select epoch_id, 0.4E0/median(fwhm)+0.2E0*(quantile_cont(mag, 0.9) filter (where err<0.2E0))/20+0.1E0*count(*)/1000+0.1E0 as score from det group by epoch_id), b as (select epoch_id from q order by score desc, epoch_id limit 1)
select epoch_id, 'own_epoch:img_'||cast(epoch_id as varchar)||':target-contaminated' as provenance from b""")
def template_choice(spark, d):
    q = epochs.epoch_quality(det(spark, d))
    best = epochs.choose_reference(q, q.select("epoch_id"))  # every exposure has the target
    return epochs.template_provenance(best, q.select("epoch_id", F.concat(F.lit("img_"), F.col("epoch_id").cast("string")).alias("stem")))


@query(f"{with_views('cand')}, g as (select truth, max(quality) as q, max(mag)-min(mag) > 1 as v, min(candidate_type) as t from cand group by truth) select truth as gid from g where v and t='brightening'")
def variable_candidates(spark, d):
    g = cand(spark, d).groupBy(F.col("truth").alias("gid")).agg((F.max("mag") - F.min("mag") > 1).alias("is_variable"), F.min("candidate_type").alias("candidate_type"))
    return viewer.variable_rows(g, "brightening", True).select("gid")


@query(f"{with_views('cand')}, g as (select truth, max(quality) as q, min(candidate_type) as t from cand group by truth), p as (select truth, t, row_number() over (order by q desc, truth) as place from g) select place, truth as gid, t as candidate_type, det_id, round(mag, 5) as mag from cand join p using (truth) where place<=32")
def plot_points(spark, d):
    x = cand(spark, d).withColumnRenamed("truth", "gid")
    g = x.groupBy("gid").agg(F.max("quality").alias("quality_score"), F.min("candidate_type").alias("candidate_type"))
    return viewer.plot_table(g, x.drop("candidate_type")).select(F.col("place").cast("long").alias("place"), "gid", "candidate_type", "det_id", r("mag").alias("mag"))


@query(f"{with_views('det')} select truth as gid, 'e_'||cast(epoch_id as varchar) as stem, det_id from det where epoch_id%2=0")
def frame_positions(spark, d):
    x = det(spark, d).select(F.col("truth").alias("gid"), F.concat(F.lit("/a/e_"), F.col("epoch_id").cast("string"), F.lit(".ecsv")).alias("source_file"), F.col("det_id").alias("x"), "y")
    f = det(spark, d).where("epoch_id % 2 = 0").select(F.concat(F.lit("/b/e_"), F.col("epoch_id").cast("string"), F.lit(".fits")).alias("path"))
    return viewer.frame_positions(x, f).select("gid", "stem", F.col("x").alias("det_id"))


@query("""with recursive p as (select vec_id, unnest(embedding)::double as v, unnest(range(64)) as i from embeddings), m as (select vec_id, median(v) as m from p group by vec_id), f as (select vec_id, i, v-m as f from p join m using (vec_id)),
n as (select vec_id, 1.4826E0*median(abs(f)) as s from f group by vec_id), b as (select vec_id, i, f from f join n using (vec_id) where f > 0.8E0*s),
e as (select p.vec_id, p.i as a, q.i as b from b p join b q on p.vec_id=q.vec_id and p.i<>q.i and abs(p.i//8-q.i//8)<=1 and abs(p.i%8-q.i%8)<=1),
reach as (select vec_id, i, i as root from b union select e.vec_id, e.b, reach.root from reach join e on e.vec_id=reach.vec_id and e.a=reach.i), c as (select vec_id, i, min(root) as root from reach group by vec_id, i),
g as (select vec_id, root, count(*) as k, sum(f) as fl, max(f) as pk, sum(f*(i%8))/sum(f) as x, sum(f*(i//8))/sum(f) as y, sum(f*(i%8)*(i%8))/sum(f) as xx, sum(f*(i//8)*(i//8))/sum(f) as yy, sum(f*(i%8)*(i//8))/sum(f) as xy from c join b using (vec_id, i) group by vec_id, root),
h as (select *, xx-x*x as vx, yy-y*y as vy, xy-x*y as vxy from g)
select vec_id, cast(root//8 as int) as py, cast(root%8 as int) as px, k as n_pixels, round(fl, 5) as flux, round(pk, 5) as peak, round(x, 5) as x, round(y, 5) as y, round(sqrt(greatest((vx+vy)/2+sqrt(pow((vx-vy)/2,2)+vxy*vxy), 0)), 4) as a from h where k>=3""")
def image_sources(spark, d):
    pix = images.pixels(spark.read.parquet(f"{d}/embeddings.parquet"), "vec_id", "embedding", 8)
    x = images.sources(pix, "vec_id", 0.8, 3)
    return x.select("vec_id", F.col("source.py").cast("int").alias("py"), F.col("source.px").cast("int").alias("px"), "n_pixels", *[r(c).alias(c) for c in ("flux", "peak", "x", "y")], r("a", 4).alias("a"))
