"""Queries over ``embeddings`` as 8 x 8 rasters: place p is row p div 8, column p mod 8; the label is the member or day."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import bytes as Layers
from ..functions import text as X
from ..operators import aggregates as A
from ..operators import grids as G
from .registry import register, table

N = 8
_P = "select vec_id, label, p, p // 8 as j, p % 8 as i, embedding[p + 1]::double as v from embeddings, (select unnest(range(64)) as p)"
_CLASS = "greatest(floor(v * 10), 0)::integer"


def tiles(spark, d):
    return table(spark, d, "embeddings").withColumn("v", F.col("embedding").cast("array<double>"))


def cells(spark, d):
    return G.cells(table(spark, d, "embeddings"), "embedding", ["vec_id", "label"], N)


def _exploded(df, name):
    return df.select("vec_id", F.posexplode(name).alias("p", "x")).select("vec_id", "p", F.round("x", 9).alias("x"))


def _stencil_sql(terms: str, weight: str, where: str = "true") -> str:
    return f"""with c as ({_P}), o as (select a.dj, b.di from (select unnest([-1, 0, 1]) as dj) a, (select unnest([-1, 0, 1]) as di) b)
    select c.vec_id, c.p::integer as p, round({terms} / {weight}, 9) as x from c, o join c n on n.vec_id = c.vec_id and n.j = c.j + o.dj and n.i = c.i + o.di where {where} group by c.vec_id, c.p"""


@register("tile_smooth", _stencil_sql("sum(n.v * (case when dj = 0 then 2 else 1 end) * (case when di = 0 then 2 else 1 end))", "sum((case when dj = 0 then 2 else 1 end) * (case when di = 0 then 2 else 1 end))"))
def tile_smooth(spark, d):
    return _exploded(tiles(spark, d).select("vec_id", G.smooth(F.col("v"), N, N).alias("s")), "s")


@register(
    "tile_gradients",
    """select vec_id, p::integer as p, round((e[p + 2]::double - e[p]::double) / 2, 9) as dx, round((e[p + 9]::double - e[p - 7]::double) / 2, 9) as dy
    from (select vec_id, embedding as e, unnest(range(64)) as p from embeddings) where p % 8 between 1 and 6 and p // 8 between 1 and 6""",
)
def tile_gradients(spark, d):
    g = tiles(spark, d).select("vec_id", F.arrays_zip(G.gradient(F.col("v"), N, N, "x").alias("dx"), G.gradient(F.col("v"), N, N, "y").alias("dy")).alias("g"))
    rows = g.select("vec_id", F.posexplode("g").alias("p", "g")).where("g.dx is not null")
    return rows.select("vec_id", "p", F.round("g.dx", 9).alias("dx"), F.round("g.dy", 9).alias("dy"))


@register(
    "tile_deformation",
    f"""with c as ({_P}), g as (select c.vec_id, c.p, (e.v - w.v) / 2 as dx, (n.v - s.v) / 2 as dy from c
    join c e on e.vec_id = c.vec_id and e.p = c.p + 1 join c w on w.vec_id = c.vec_id and w.p = c.p - 1 join c n on n.vec_id = c.vec_id and n.p = c.p + 8 join c s on s.vec_id = c.vec_id and s.p = c.p - 8
    where c.i between 1 and 6 and c.j between 1 and 6)
    select u.vec_id, round(max(sqrt((u.dx - v.dy) ^ 2 + (v.dx + u.dy) ^ 2)), 9) as deformation from g u join g v on v.vec_id = u.vec_id + 1 and v.p = u.p where u.vec_id % 2 = 0 group by u.vec_id""",
)
def tile_deformation(spark, d):
    """Even tiles are the west-east part of the wind and the next tile is its south-north part."""
    t = tiles(spark, d)
    g = t.select("vec_id", G.gradient(F.col("v"), N, N, "x").alias("dx"), G.gradient(F.col("v"), N, N, "y").alias("dy"))
    u = g.where("vec_id % 2 = 0").select("vec_id", F.col("dx").alias("ux"), F.col("dy").alias("uy"))
    v = g.where("vec_id % 2 = 1").select((F.col("vec_id") - 1).alias("vec_id"), F.col("dx").alias("vx"), F.col("dy").alias("vy"))
    both = u.join(v, "vec_id").select("vec_id", F.arrays_zip("ux", "uy", "vx", "vy").alias("z"))
    size = F.transform("z", lambda z: F.sqrt(F.pow(z["ux"] - z["vy"], F.lit(2)) + F.pow(z["vx"] + z["uy"], F.lit(2))))
    return both.select("vec_id", F.round(F.array_max(size), 9).alias("deformation"))


@register("tile_wind_speed", f"with c as ({_P}) select u.vec_id, round(max(sqrt(u.v * u.v + w.v * w.v) * 1.943844), 9) as knots from c u join c w on w.vec_id = u.vec_id + 1 and w.p = u.p where u.vec_id % 2 = 0 group by u.vec_id")
def tile_wind_speed(spark, d):
    t = tiles(spark, d)
    u, w = t.where("vec_id % 2 = 0").select("vec_id", F.col("v").alias("u")), t.where("vec_id % 2 = 1").select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("w"))
    speeds = F.zip_with("u", "w", lambda a, b: F.sqrt(a * a + b * b) * 1.943844)
    return u.join(w, "vec_id").select("vec_id", F.round(F.array_max(speeds), 9).alias("knots"))


@register(
    "tile_window_peak",
    f"""with c as ({_P}), s as (select c.vec_id, c.p, sum(n.k) as s from (select *, floor(v * 1000)::bigint as k from c) c join (select *, floor(v * 1000)::bigint as k from c) n
    on n.vec_id = c.vec_id and abs(n.j - c.j) <= 2 and abs(n.i - c.i) <= 2 group by all)
    select vec_id, s::double as peak, p::integer as at from (select *, row_number() over (partition by vec_id order by s desc, p) as r from s) where r = 1""",
)
def tile_window_peak(spark, d):
    sums = G.window_sums(F.transform("v", lambda x: F.floor(x * 1000).cast("double")), N, N, 2)
    t = tiles(spark, d).select("vec_id", sums.alias("s"))
    return t.select("vec_id", F.array_max("s").alias("peak"), G.first_argmax(F.col("s")).cast("int").alias("at"))


@register("tile_block_max", f"with c as ({_P}) select vec_id, (j // 2)::integer as bj, (i // 2)::integer as bi, round(max(v), 9) as top from c group by all")
def tile_block_max(spark, d):
    c = cells(spark, d)
    return c.groupBy("vec_id", F.floor(F.col("j") / 2).cast("int").alias("bj"), F.floor(F.col("i") / 2).cast("int").alias("bi")).agg(F.round(F.max("v"), 9).alias("top"))


@register(
    "tile_block_statistics",
    f"""with c as ({_P}), b as (select vec_id, (j // 4)::integer as bj, (i // 4)::integer as bi, list(v order by v) as s from c group by all)
    select vec_id, bj, bi, round(s[12], 9) as fifth_highest, round((s[8] + s[9]) / 2, 9) as median, round(s[16], 9) as top, (s[12] >= 0.1)::integer + (s[12] >= 0.2)::integer as class from b""",
)
def tile_block_statistics(spark, d):
    g = cells(spark, d).groupBy("vec_id", F.floor(F.col("j") / 4).cast("int").alias("bj"), F.floor(F.col("i") / 4).cast("int").alias("bi"))
    b = g.agg(A.kth_highest(F.col("v"), 5).alias("k"), F.median("v").alias("m"), F.max("v").alias("t"))
    return b.select("vec_id", "bj", "bi", F.round("k", 9).alias("fifth_highest"), F.round("m", 9).alias("median"), F.round("t", 9).alias("top"), ((F.col("k") >= 0.1).cast("int") + (F.col("k") >= 0.2).cast("int")).alias("class"))


@register(
    "tile_run_length",
    f"""with c as (select vec_id, p, {_CLASS} as k from ({_P})), g as (select *, p - row_number() over (partition by vec_id, k order by p) as r from c),
    runs as (select vec_id, min(p) as p, any_value(k) as k, count(*) as n from g group by vec_id, k, r)
    select vec_id, string_agg(case when n > 1 then k || '*' || n else k::varchar end, ',' order by p) as code, sum(n)::bigint as n from runs group by vec_id""",
)
def tile_run_length(spark, d):
    t = tiles(spark, d).select("vec_id", X.run_length(F.transform("v", lambda x: F.greatest(F.floor(x * 10), F.lit(0)).cast("int"))).alias("code"))
    return t.select("vec_id", "code", X.run_length_count(F.col("code")).alias("n"))


@register("tile_run_length_round_trip", f"select vec_id, list({_CLASS} order by p) as decoded from ({_P}) group by vec_id")
def tile_run_length_round_trip(spark, d):
    k = F.transform("v", lambda x: F.greatest(F.floor(x * 10), F.lit(0)).cast("int"))
    return tiles(spark, d).select("vec_id", X.run_length_decoded(X.run_length(k)).alias("decoded"))


@register(
    "tile_ensemble_share",
    f"with c as ({_P}) select p::integer as p, sum((v > 0.1)::integer)::bigint as hits, count(*) as seen, floor(100.0 * sum((v > 0.1)::integer) / count(*) + 0.5)::bigint as share from c group by p having count(distinct label) >= 5",
)
def tile_ensemble_share(spark, d):
    flags = cells(spark, d).select("p", (F.col("v") > 0.1).alias("flag"), "label")
    return A.member_share(flags, ["p"], "flag", "label", 5).drop("members")


@register(
    "tile_agreement",
    f"with c as ({_P}) select a.vec_id, floor(100.0 * avg(((a.v > 0.1) = (b.v > 0.1))::integer) + 0.5)::bigint as percent from c a join c b on b.vec_id = a.vec_id + 1 and b.p = a.p group by a.vec_id",
)
def tile_agreement(spark, d):
    t = tiles(spark, d).select("vec_id", F.transform("v", lambda x: x > 0.1).alias("f"))
    after = t.select((F.col("vec_id") - 1).alias("vec_id"), F.col("f").alias("g"))
    same = F.size(F.filter(F.zip_with("f", "g", lambda a, b: a == b), lambda x: x))
    return t.join(after, "vec_id").select("vec_id", F.floor(100.0 * same / F.size("f") + 0.5).cast("long").alias("percent"))


@register("tile_daily_maximum", f"with c as ({_P}) select label, p::integer as p, round(max(v), 9) as top, (max(v) >= 0.25)::integer + (max(v) >= 0.3)::integer as class from c group by all")
def tile_daily_maximum(spark, d):
    g = cells(spark, d).groupBy("label", "p").agg(F.max("v").alias("m"))
    return g.select("label", "p", F.round("m", 9).alias("top"), ((F.col("m") >= 0.25).cast("int") + (F.col("m") >= 0.3).cast("int")).alias("class"))


@register(
    "tile_class_histogram",
    f"""with c as ({_P}), m as (select label, p, max(v) as m from c group by all)
    select label, count(*) filter (m < 0.25) as none, count(*) filter (m >= 0.25 and m < 0.3) as light, count(*) filter (m >= 0.3) as heavy, arg_max(p, (m, -p))::integer as top_at from m group by label""",
)
def tile_class_histogram(spark, d):
    m = cells(spark, d).groupBy("label", "p").agg(F.max("v").alias("m"))
    peak = F.max(F.struct("m", (-F.col("p")).alias("k")))
    return m.groupBy("label").agg(F.count_if(F.col("m") < 0.25).alias("none"), F.count_if((F.col("m") >= 0.25) & (F.col("m") < 0.3)).alias("light"), F.count_if(F.col("m") >= 0.3).alias("heavy"), (-peak["k"]).alias("top_at"))


@register("tile_nearest", f"with c as ({_P}), q as (select vec_id, (vec_id % 70) / 10.0 as y, (vec_id % 90) / 10.0 - 0.6 as x from embeddings) select q.vec_id, round(c.v, 9) as v from q left join c on c.vec_id = q.vec_id and c.j = floor(q.y + 0.5) and c.i = floor(q.x + 0.5)")
def tile_nearest(spark, d):
    y, x = (F.col("vec_id") % 70) / 10.0, (F.col("vec_id") % 90) / 10.0 - 0.6
    return tiles(spark, d).select("vec_id", F.round(G.at(F.col("v"), F.floor(y + 0.5), F.floor(x + 0.5), N, N), 9).alias("v"))


@register(
    "tile_bilinear",
    """with f as (select vec_id, embedding as e, floor((vec_id % 70) / 10.0)::integer as j, floor((vec_id % 69) / 10.0)::integer as i, (vec_id % 70) / 10.0 - floor((vec_id % 70) / 10.0) as fy, (vec_id % 69) / 10.0 - floor((vec_id % 69) / 10.0) as fx from embeddings),
    g as (select *, least(j + 1, 7) as jn, least(i + 1, 7) as n from f)
    select vec_id, round(e[j * 8 + i + 1]::double * (1 - fy) * (1 - fx) + e[j * 8 + n + 1]::double * (1 - fy) * fx + e[jn * 8 + i + 1]::double * fy * (1 - fx) + e[jn * 8 + n + 1]::double * fy * fx, 9) as v from g""",
)
def tile_bilinear(spark, d):
    y, x = (F.col("vec_id") % 70) / 10.0, (F.col("vec_id") % 69) / 10.0
    return tiles(spark, d).select("vec_id", F.round(G.bilinear(F.col("v"), y, x, N, N), 9).alias("v"))


@register("tile_crop", f"with c as ({_P}) select vec_id, list(round(v, 9) order by p) as part from c where j between 2 and 5 and i between 1 and 6 group by vec_id")
def tile_crop(spark, d):
    rows = F.flatten(F.transform(F.sequence(F.lit(2), F.lit(5)), lambda j: F.slice("v", j * N + 2, F.lit(6))))
    return tiles(spark, d).select("vec_id", F.transform(rows, lambda x: F.round(x, 9)).alias("part"))


@register("tile_box_scan", f"with c as ({_P}) select vec_id, count(*) filter (v > 0) as n, arg_max(p, (v, -p))::integer as top_at from c where j between 2 and 5 and i between 1 and 6 group by vec_id")
def tile_box_scan(spark, d):
    c = cells(spark, d).where("j between 2 and 5 and i between 1 and 6")
    peak = F.max(F.struct("v", (-F.col("p")).alias("k")))
    return c.groupBy("vec_id").agg(F.count_if(F.col("v") > 0).alias("n"), (-peak["k"]).alias("top_at"))


@register(
    "tile_level_summary",
    f"""with c as (select label, floor(v * 1000)::bigint as k from ({_P}) where v > 0), s as (select label, list(k order by k) as s, count(*) as n from c group by label)
    select label, s[floor(0.1 * (n - 1) + 0.5)::bigint + 1] * 5 as p10, s[floor(0.5 * (n - 1) + 0.5)::bigint + 1] * 5 as p50, s[floor(0.9 * (n - 1) + 0.5)::bigint + 1] * 5 as p90, s[1] * 5 as low, s[n] * 5 as high from s""",
)
def tile_level_summary(spark, d):
    """Exact ranks from counts of each value: a running sum over distinct values, never all values in one place."""
    c = cells(spark, d).where("v > 0").groupBy("label", F.floor(F.col("v") * 1000).cast("long").alias("k")).agg(F.count("*").alias("c"))
    w = Window.partitionBy("label").orderBy("k")
    run = c.withColumn("to", F.sum("c").over(w)).withColumn("n", F.sum("c").over(Window.partitionBy("label")))
    rank = lambda p: F.min(F.when(F.col("to") > F.floor(p * (F.col("n") - 1) + 0.5), F.col("k"))) * 5
    return run.groupBy("label").agg(rank(0.1).alias("p10"), rank(0.5).alias("p50"), rank(0.9).alias("p90"), (F.min("k") * 5).alias("low"), (F.max("k") * 5).alias("high"))


@register("tile_level_at_peak", f"with c as ({_P}) select label, p::integer as p, arg_max(vec_id, (v, -vec_id)) as level from c group by all")
def tile_level_at_peak(spark, d):
    peak = F.max(F.struct("v", (-F.col("vec_id")).alias("k")))
    return cells(spark, d).groupBy("label", "p").agg((-peak["k"]).alias("level"))


@register(
    "tile_profile_crossing",
    f"""with c as ({_P}), s as (select vec_id, p, v, lead(v) over (partition by vec_id order by p) as nv from c where j = 3)
    select vec_id, round(min(p + (0.05 - v) / (nv - v)), 6) as at from s where (v < 0.05) <> (nv < 0.05) group by vec_id""",
)
def tile_profile_crossing(spark, d):
    """The first crossing of 0.05 along row 3, by linear interpolation."""
    w = Window.partitionBy("vec_id").orderBy("p")
    s = cells(spark, d).where("j = 3").withColumn("nv", F.lead("v").over(w)).where((F.col("v") < 0.05) != (F.col("nv") < 0.05))
    return s.groupBy("vec_id").agg(F.round(F.min(F.col("p") + (0.05 - F.col("v")) / (F.col("nv") - F.col("v"))), 6).alias("at"))


@register("tile_field_catalogue", "select vec_id, case when label in (0, 1) then 'UGRD' when label in (2, 3) then 'VGRD' when label = 4 then 'HGT' end || ':' || (250 + 50 * (label % 3)) as field from embeddings where label <= 4")
def tile_field_catalogue(spark, d):
    #: Which field a label stands for.
    catalogue = spark.createDataFrame([(0, "UGRD"), (1, "UGRD"), (2, "VGRD"), (3, "VGRD"), (4, "HGT")], "label int, name string")
    t = table(spark, d, "embeddings").join(F.broadcast(catalogue), "label")
    return t.select("vec_id", F.concat("name", F.lit(":"), (250 + 50 * (F.col("label") % 3)).cast("string")).alias("field"))


@register("tile_percentile_calibration", f"""with c as ({_P}), t as (select i, quantile_disc(v, 0.95) as limit_ from c group by i) select c.i::integer as i, count(*) filter (c.v >= limit_) as above from c join t using (i) group by c.i""")
def tile_percentile_calibration(spark, d):
    """The limits are one row for each of the eight columns of a tile."""
    c = cells(spark, d)
    t = A.at_ranks(c, ["i"], "v", {"limit": lambda n: F.ceil(0.95 * n) - 1}).drop("n")
    return c.join(F.broadcast(t), "i").groupBy("i").agg(F.count_if(F.col("v") >= F.col("limit")).alias("above"))


@register("tile_lattice", f"with c as ({_P}) select label, j::integer as j, i::integer as i, (25.0 + j * 0.5)::double as lat, (-80.0 + i * 0.5)::double as lon, count(*) as tiles, round(avg(v), 6) as mean from c group by label, j, i")
def tile_lattice(spark, d):
    """The lattice that each label's tiles are published on, with the mean of what lies at its points."""
    c = cells(spark, d).groupBy("label", "j", "i").agg(F.count("*").alias("tiles"), F.round(F.avg("v"), 6).alias("mean"))
    return c.select("label", "j", "i", (25.0 + F.col("j") * 0.5).alias("lat"), (-80.0 + F.col("i") * 0.5).alias("lon"), "tiles", "mean")


@register(
    "tile_gradients_per_km",
    """select vec_id, p::integer as p, round((e[p + 2]::double - e[p]::double) / 2 / (111.32 * 2.5 * cos(radians(40.0 + (p // 8) * 2.5))) * 1000, 9) as dx, round((e[p + 9]::double - e[p - 7]::double) / 2 / (111.32 * 2.5) * 1000, 9) as dy
    from (select vec_id, embedding as e, unnest(range(64)) as p from embeddings) where p % 8 between 1 and 6 and p // 8 between 1 and 6""",
)
def tile_gradients_per_km(spark, d):
    """Gradients per 1,000 km of tiles of 2.5 degrees from 40 north: a degree of longitude is shorter further north."""
    g = tiles(spark, d).select("vec_id", F.arrays_zip(G.metric_gradient(F.col("v"), N, N, "x", 40.0, 2.5).alias("dx"), G.metric_gradient(F.col("v"), N, N, "y", 40.0, 2.5).alias("dy")).alias("g"))
    rows = g.select("vec_id", F.posexplode("g").alias("p", "g")).where("g.dx is not null")
    return rows.select("vec_id", "p", F.round(F.col("g.dx") * 1000, 9).alias("dx"), F.round(F.col("g.dy") * 1000, 9).alias("dy"))


@register(
    "tile_resampled",
    """with q as (select vec_id, embedding as e, j, i, floor(0.25 + 1.6 * j + 0.5)::integer as y, floor(-0.75 + 1.9 * i + 0.5)::integer as x from embeddings, range(5) a(j), range(6) b(i))
    select vec_id, (j * 6 + i)::integer as p, case when y between 0 and 7 and x between 0 and 7 then e[y * 8 + x + 1]::double end as v from q""",
)
def tile_resampled(spark, d):
    """The nearest values at the points of a coarser frame of 5 by 6 that reaches beyond the tile."""
    t = tiles(spark, d).select("vec_id", G.resampled(F.col("v"), N, (0.25, 1.6, 5), (-0.75, 1.9, 6), N).alias("r"))
    return t.select("vec_id", F.posexplode("r").alias("p", "v"))


@register(
    "tile_byte_layers",
    f"""with c as ({_P}), b as (select vec_id, p, case when v > 0 then least(greatest(floor(v * 1000 / 5 + 0.5), 1), 255)::integer else 0 end as b from c)
    select vec_id, to_base64(unhex(string_agg(lpad(to_hex(b), 2, '0'), '' order by p))) as layer, sum(b * 5)::bigint as total, count(*) filter (b >= 20)::integer as strong from b group by vec_id""",
)
def tile_byte_layers(spark, d):
    """Tiles as a byte a cell in steps of 5, base64, and what is read back from it; cells of 96 or more are counted on the bytes."""
    t = tiles(spark, d).select("vec_id", Layers.packed(F.transform("v", lambda v: v * 1000), 5.0).alias("layer"))
    back = Layers.unpacked(F.col("layer"), 5.0)
    return t.select("vec_id", "layer", F.aggregate(back, F.lit(0.0), lambda s, v: s + v).cast("long").alias("total"), Layers.cells_at_least(F.col("layer"), 5.0, 96.0).alias("strong"))


@register(
    "tile_class_layers",
    f"""with m as (select vec_id, max(v) as top, min(v) as low from ({_P}) group by vec_id),
    c as (select c.vec_id, p, least(greatest(floor(v / case when top > 0.3 then 0.1 else 0.05 end), 0), 3)::integer as k, case when top > 0.3 then 'wide' else 'narrow' end as convention from ({_P}) c join m using (vec_id) where low > -0.35),
    g as (select *, p - row_number() over (partition by vec_id, k order by p) as r from c), runs as (select vec_id, convention, min(p) as p, any_value(k) as k, count(*) as n from g group by vec_id, convention, k, r)
    select vec_id, convention, string_agg(case when n > 1 then k || '*' || n else k::varchar end, ',' order by p) as layer, coalesce(sum(n) filter (k = 3), 0)::integer as severe from runs group by vec_id, convention""",
)
def tile_class_layers(spark, d):
    """A published layer of each tile: its convention found, odd tiles left out, classes of its values, run lengths, severe cells."""
    t = tiles(spark, d).withColumn("top", F.array_max("v")).where(F.array_min("v") > -0.35)
    t = t.withColumn("convention", F.when(F.col("top") > 0.3, "wide").otherwise("narrow")).withColumn("step", F.when(F.col("top") > 0.3, 0.1).otherwise(0.05))
    t = t.withColumn("k", F.transform("v", lambda x: F.least(F.greatest(F.floor(x / F.col("step")), F.lit(0)), F.lit(3)).cast("int")))
    return t.select("vec_id", "convention", X.run_length(F.col("k")).alias("layer"), F.size(F.filter("k", lambda x: x == 3)).alias("severe"))


@register(
    "tile_parallel_means",
    f"""with c as ({_P}), m as (select vec_id, label, j, avg(v) * 1.943844 as knots, sum(v * cos(radians(30.0 + j * 5))) as weighted, sum(cos(radians(30.0 + j * 5))) as weight from c group by all),
    d as (select vec_id, label, max(knots) as top, arg_max(j, (knots, -j)) as row_, sum(weighted) / sum(weight) as mean from m group by all)
    select label, count(*) as tiles, round(avg(top), 9) as top, round(avg(mean) filter (mean > 0), 9) as westerly, count(*) filter (mean > 0) as westerlies, mode(row_ order by row_)::integer as usual_row from d group by label""",
)
def tile_parallel_means(spark, d):
    """Winds along parallels five degrees apart: each tile's strongest parallel in knots and its mean by area; by label the usual
    parallel, the mean of strongest ones, and of tiles whose mean is westerly."""
    c = cells(spark, d)
    w = F.cos(F.radians(30.0 + F.col("j") * 5))
    rows = c.groupBy("vec_id", "label", "j").agg((F.avg("v") * 1.943844).alias("knots"), F.sum(F.col("v") * w).alias("weighted"), F.sum(w).alias("weight"))
    best = F.max(F.struct("knots", (-F.col("j")).alias("k")))
    t = rows.groupBy("vec_id", "label").agg(best.alias("b"), (F.sum("weighted") / F.sum("weight")).alias("mean"))
    west = F.when(F.col("mean") > 0, F.col("mean"))
    by_row = t.groupBy("label", (-F.col("b.k")).cast("int").alias("row_")).agg(F.count("*").alias("n")).groupBy("label").agg((-F.max(F.struct("n", (-F.col("row_")).alias("r")))["r"]).cast("int").alias("usual_row"))
    g = t.groupBy("label").agg(F.count("*").alias("tiles"), F.round(F.avg("b.knots"), 9).alias("top"), F.round(F.avg(west), 9).alias("westerly"), F.count(west).alias("westerlies"))
    return g.join(by_row, "label")
