"""Band maths, composites, boxes, cells, zones."""

from __future__ import annotations

from pyspark.sql import functions as F

from harrow.operators import fields as D
from harrow.operators import pixels as P
from harrow.operators import regions as G
from harrow.plans import fixtures as X
from harrow.plans.registry import query, rounded
from harrow.session import scratch_path
from harrow.sources.pixels import read_bands as scan_bands
from harrow.sources.pixels import read_pixels as scan_pixels
from harrow.sources.pixels import write_bands as sink_bands

_BANDS = ["B04", "B03", "B02"]


@query("S9", "SELECT l_suppkey, l_partkey, l_discount, l_tax FROM lineitem")
def read_pixels(spark, sf):
    return scan_pixels(spark, f"{sf}/lineitem.parquet", ["l_discount", "l_tax"], ["l_suppkey", "l_partkey"])


def _stretched(band: str) -> str:
    v = f"(0.6 * {band} - 0.035)"
    return f"round(1.75 * sign({v}) * pow(abs({v}), 1.0 / 3), 6)"


@query(
    "P1 P2",
    f"SELECT x, y, {_stretched('B04')} AS R, {_stretched('B03')} AS G, {_stretched('B02')} AS B, dataMask AS mask FROM v_pixels",
    ("v_pixels",),
)
def highlight(spark, sf):
    return rounded(P.highlight(X.v_pixels(spark, sf)))


@query(
    "P3",
    "SELECT x, y, period, " + ", ".join(f"CASE WHEN dataMask = 1 THEN {b} END AS {b}" for b in _BANDS) + ", dataMask FROM v_pixels",
    ("v_pixels",),
)
def mask(spark, sf):
    return P.mask(X.v_pixels(spark, sf), "dataMask", _BANDS)


@query(
    "S10",
    "SELECT strftime(l_shipdate, '%Y-%m-%d') AS scene_date, count(*) AS n, round(sum(l_discount), 4) AS b04, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) AS BIGINT) AS clear FROM lineitem GROUP BY 1",
)
def write_bands(spark, sf):
    """Write the bands by scene date, read them back, and total them per date."""
    li = X.table(spark, sf, "lineitem")
    bands = li.select(
        F.col("l_shipdate").alias("scene_ts"),
        F.col("l_discount").alias("B04"),
        F.when(F.col("l_returnflag") == "R", 0).otherwise(1).alias("mask"),
    )
    path = scratch_path(spark, "bands")
    # The second call writes half of the scenes again, which replaces them.
    again = F.pmod(F.xxhash64("scene_ts"), F.lit(2)) == 0
    sink_bands(bands, path)
    sink_bands(bands.where(again), path)
    back = scan_bands(spark, path)
    return rounded(
        back.groupBy(F.col("scene_date").cast("string").alias("scene_date")).agg(
            F.count("*").alias("n"), F.sum("B04").alias("b04"), F.sum("mask").alias("clear")
        ),
        4,
    )


def _composite_sql(fn: str) -> str:
    return (
        "SELECT x, y, period, "
        + ", ".join(f"round({fn.format(b)}, 6) AS {b}" for b in [f"CASE WHEN dataMask = 1 THEN {b} END" for b in _BANDS])
        + ", count(*) FILTER (dataMask = 1) AS clear FROM v_pixels GROUP BY x, y, period"
    )


def _named(sql: str) -> str:
    for b in _BANDS:
        sql = sql.replace(f" AS CASE WHEN dataMask = 1 THEN {b} END", f" AS {b}")
    return sql


@query("A20", _named(_composite_sql("quantile_cont({}, 0.5)")), ("v_pixels",))
def composite_median(spark, sf):
    return rounded(P.composite(X.v_pixels(spark, sf), _BANDS, "median"))


@query("A20", _named(_composite_sql("avg({})")), ("v_pixels",))
def composite_mean(spark, sf):
    return rounded(P.composite(X.v_pixels(spark, sf), _BANDS, "mean"))


@query("A20", _named(_composite_sql("max({})")), ("v_pixels",))
def composite_max(spark, sf):
    return rounded(P.composite(X.v_pixels(spark, sf), _BANDS, "max"))


@query(
    "J12",
    """SELECT vec_id, label, lon, lat, box FROM v_points JOIN v_boxes
      ON lon BETWEEN min_lon AND max_lon AND lat BETWEEN min_lat AND max_lat""",
    ("v_points", "v_boxes"),
)
def clip_bbox(spark, sf):
    return G.clip_bbox(X.v_points(spark, sf), X.v_boxes(spark, sf))


@query(
    "J13",
    """WITH c AS (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS variant, l_suppkey AS x, l_partkey % 50 AS y, l_linestatus = 'O' AS p, l_returnflag = 'A' AS t FROM lineitem),
      m AS (SELECT variant, x, y, max(p::INT) AS p, max(t::INT) AS t FROM c GROUP BY ALL HAVING max(p::INT) + max(t::INT) > 0),
      g AS (SELECT variant, sum(p * t) AS b, sum(p) AS p, sum(t) AS t, count(*) AS n FROM m GROUP BY variant)
    SELECT variant, b::BIGINT AS "both", p::BIGINT AS pred_cells, t::BIGINT AS true_cells, round(b / n, 9) AS iou,
      round(coalesce(b / nullif(p, 0), 0), 9) AS precision, round(coalesce(b / nullif(t, 0), 0), 9) AS recall FROM g""",
)
def region_iou(spark, sf):
    pred, true = X.v_cells(spark, sf)
    return rounded(G.region_iou(pred, true, ["variant"]).drop("either"), 9)


_ZONES = "SELECT l_suppkey AS zone, l_returnflag AS cls, count(*) AS n FROM lineitem GROUP BY 1, 2"


@query(
    "A22",
    f"""SELECT zone, cls AS majority, round(n / sum(n) OVER (PARTITION BY zone), 9) AS share, CAST(sum(n) OVER (PARTITION BY zone) AS BIGINT) AS size
    FROM ({_ZONES}) QUALIFY row_number() OVER (PARTITION BY zone ORDER BY n DESC, cls) = 1""",
)
def zonal_majority(spark, sf):
    px = X.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("zone"), F.col("l_returnflag").alias("cls"))
    return rounded(G.zonal_majority(px, ["zone"]), 9)


@query("A22", f"SELECT zone, cls, n, round(n / sum(n) OVER (PARTITION BY zone), 9) AS share FROM ({_ZONES})")
def zonal_shares(spark, sf):
    px = X.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("zone"), F.col("l_returnflag").alias("cls"))
    return rounded(G.zonal_shares(px, ["zone"]), 9)


def _labels_sql(name: str, condition: str) -> str:
    """SQL of all cells that a cell reaches side by side, and its region's smallest cell."""
    near = "c.variant = r.variant AND abs(c.x - r.x) + abs(c.y - r.y) = 1"
    return f"""{name}_cells AS (SELECT DISTINCT variant, x, y FROM v_field_lines WHERE {condition}),
      {name}_reach AS (SELECT variant, x, y, x AS to_x, y AS to_y FROM {name}_cells
        UNION SELECT c.variant, c.x, c.y, r.to_x, r.to_y FROM {name}_reach r JOIN {name}_cells c ON {near}),
      {name}_far AS (SELECT variant, x, y, min({{'x': to_x, 'y': to_y}}) AS region FROM {name}_reach GROUP BY ALL)"""


# Recursive tables need the keyword at the head of the whole list.
_FIELDS = f"""WITH RECURSIVE v_field_lines AS ({X.VIEWS["v_field_lines"]}), {_labels_sql("pred", "l_quantity > 8")}, {_labels_sql("true", "l_discount < 0.09")},
  pred AS (SELECT * FROM pred_far), tru AS (SELECT * FROM true_far),
  ps AS (SELECT variant, region, count(*) AS n FROM pred GROUP BY ALL), ts AS (SELECT variant, region, count(*) AS n FROM tru GROUP BY ALL),
  o AS (SELECT variant, p.region AS pr, t.region AS tr, count(*) AS k FROM pred p JOIN tru t USING (variant, x, y) GROUP BY ALL),
  w AS (SELECT variant, pr, tr, ps.n AS pn, ts.n AS tn, k FROM o JOIN ps USING (variant) JOIN ts USING (variant) WHERE ps.region = pr AND ts.region = tr
    UNION ALL SELECT variant, region, NULL, n, 0, 0 FROM ps WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.variant = ps.variant AND o.pr = ps.region)
    UNION ALL SELECT variant, NULL, region, 0, n, 0 FROM ts WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.variant = ts.variant AND o.tr = ts.region)),
  i AS (SELECT variant, pr, tr, pn, tn, k, k / CAST(pn + tn - k AS DOUBLE) AS iou FROM w)"""


def _field_labels(spark, sf, tile=64):
    pred, true = X.v_fields(spark, sf)
    return D.label_regions(pred, ["variant"], tile=tile), D.label_regions(true, ["variant"], tile=tile)


@query("J13", _FIELDS + " SELECT variant, x, y, region.x AS region_x, region.y AS region_y FROM pred")
def region_labels(spark, sf):
    return _field_labels(spark, sf, 16)[0]


@query(
    "J13",
    _FIELDS
    + """ SELECT variant, pr.x AS pred_x, pr.y AS pred_y, tr.x AS true_x, tr.y AS true_y, CAST(pn AS BIGINT) AS pred_cells, CAST(tn AS BIGINT) AS true_cells,
      CAST(k AS BIGINT) AS "both", round(iou, 6) AS iou FROM i""",
)
def region_overlaps(spark, sf):
    return rounded(D.region_overlaps(*_field_labels(spark, sf), ["variant"]))


@query(
    "J13",
    _FIELDS
    + """, a AS (SELECT variant, count(DISTINCT pr) AS p, count(DISTINCT tr) AS t, count(*) FILTER (iou > 0.5) AS m, avg(iou) FILTER (iou > 0.5) AS mean FROM i GROUP BY ALL),
      s AS (SELECT variant, count(*) AS split FROM (SELECT variant, tr FROM i WHERE k > 0 GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL),
      g AS (SELECT variant, count(*) AS merged FROM (SELECT variant, pr FROM i WHERE k > 0 GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL)
    SELECT variant, p AS pred_regions, t AS true_regions, m AS matches, round(CASE WHEN p > 0 THEN m / CAST(p AS DOUBLE) ELSE 0 END, 6) AS precision,
      round(CASE WHEN t > 0 THEN m / CAST(t AS DOUBLE) ELSE 0 END, 6) AS recall, round(2.0::DOUBLE * m / (p + t), 6) AS f1, round(coalesce(mean, 0), 6) AS mean_iou,
      coalesce(split, 0) AS split, coalesce(merged, 0) AS merged FROM a LEFT JOIN s USING (variant) LEFT JOIN g USING (variant)""",
)
def region_scores(spark, sf):
    return rounded(D.region_scores(D.region_overlaps(*_field_labels(spark, sf), ["variant"]), ["variant"]))
