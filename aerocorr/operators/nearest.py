"""Nearest sites without a cross join.

Positions and sites are bucketed on a square grid and joined on the cell key,
so each position only meets the sites in the 3x3 block of cells around it.
A block of cells of width ``c`` contains every site within ``c / (1 + GUARD)``
of the position (the guard absorbs rounding of ``floor(x / c)`` at cell
edges), which makes the search exact:

* bounded search (``radius``): one grid level with ``c = radius * (1 + GUARD)``;
  a nearest site at distance ``< radius`` is always a candidate.
* unbounded search: phase 0 runs this fine level for every position.  A key
  whose best candidate lies within the level's guaranteed radius is exact.  The
  others descend a hierarchy of the cells that hold sites, from cells that hold
  everything down to the fine level: of each level's cells a key keeps those
  whose nearest corner is not beyond its bound, and its bound is the least of
  its phase-0 candidate and the farthest corners seen so far.  Only the fine
  cells that survive are joined with the sites, so a far-off sensor meets the
  sites around its nearest one and never all of them.

Ties are kept (``rank() == 1`` per key), which Spark plans as a
WindowGroupLimit that already trims candidates before the shuffle.  NULL,
NaN or infinite coordinates on either side never match.

Work and actions: small aggregates over the site table pick the base cell
(bounding box; occupancy, so no cell holds more than ``CELL_CAP`` sites unless
they coincide); phase 0's rank-1 rows are checkpointed in the shared checkpoint
folder, a bounded probe (``limit(1)``) decides whether the descent is needed at
all, and the descent writes its pairs every few levels.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerocorr.config import ensure_checkpoint_dir
from aerocorr.functions.geo import grid_cell, planar_distance
from aerocorr.sources.sinks import materialize

GUARD = 1e-3        # cell width = guaranteed radius * (1 + GUARD)
STEP_BITS = 2       # a level of the descent splits a cell into 4 x 4
WRITE_EVERY = 4     # levels between written tables of the descent


def _usable(a: str, b: str):
    """Finite coordinates (NULL, NaN and infinities never match)."""
    inf = float("inf")
    return (F.col(a).isNotNull() & F.col(b).isNotNull()
            & ~F.isnan(F.col(a)) & ~F.isnan(F.col(b))
            & (F.abs(F.col(a)) < F.lit(inf)) & (F.abs(F.col(b)) < F.lit(inf)))


def _clean_sides(positions, sites, lat, lon, site_lat, site_lon, distinct_sites=True):
    clash = (set(positions.columns) & set(sites.columns))
    if clash:
        raise ValueError(f"positions and sites share column names {sorted(clash)}; rename one side")
    pos = positions.where(_usable(lat, lon))
    st = sites.where(_usable(site_lat, site_lon))
    # duplicated site rows would duplicate ties; a site is its full row
    return pos, (st.distinct() if distinct_sites else st)


def _block():
    """The 3x3 block of cell offsets around a cell."""
    return F.array(*[F.struct(F.lit(dx).alias("_dx"), F.lit(dy).alias("_dy"))
                     for dx in (-1, 0, 1) for dy in (-1, 0, 1)])


def _offsets(df: DataFrame, x: str, y: str) -> DataFrame:
    """Replicate every row into the 3x3 block of cells around ``(x, y)``
    (one generator, one projection)."""
    rest = [c for c in df.columns if c not in (x, y)]
    return (df.select("*", F.inline(_block()))
              .select(*rest, (F.col(x) + F.col("_dx")).alias(x), (F.col(y) + F.col("_dy")).alias(y)))


def _rank1(df: DataFrame, key: list[str], dist_col: str) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(F.col(dist_col))
    cols = df.columns
    return df.select("*", F.rank().over(w).alias("_rk")).where(F.col("_rk") == 1).select(*cols)


def _with_cell(pos, cell, lat, lon):
    return pos.withColumns({"_cx": grid_cell(lat, cell), "_cy": grid_cell(lon, cell)})


def _level0(pos, st, cell, lat, lon, site_lat, site_lon, dist_col):
    """``pos`` already carries its level-0 cell ``(_cx, _cy)``."""
    p = pos
    s = _offsets(_with_cell(st, cell, site_lat, site_lon), "_cx", "_cy")
    cand = p.join(s, ["_cx", "_cy"]).drop("_cx", "_cy")
    return cand.withColumn(dist_col, planar_distance(lat, lon, site_lat, site_lon))


def nearest_within(positions: DataFrame, sites: DataFrame, radius: float, *,
                   key: str | list[str] = "sensor_id", lat: str = "lat", lon: str = "lon",
                   site_lat: str = "latitude", site_lon: str = "longitude",
                   dist_col: str = "dist", distinct_sites: bool = True,
                   cell: float | None = None) -> DataFrame:
    """Per key, every site at minimum distance when that distance is strictly
    below ``radius`` (ties kept).  Keys with no site that close are absent.

    Where sites are sparse relative to the radius this is one grid equi-join
    with cells of the radius' width.  Where they are dense, the first pass
    runs on the finer occupancy-capped cells and only keys left without a
    resolved candidate take a second pass, bounded by their best candidate
    or the radius - so a dense cluster is not paired with every position
    within the radius of it.  ``distinct_sites=False`` skips de-duplicating
    identical site rows (a shuffle) when the caller de-duplicates anyway.
    The two-pass form reads ``positions`` more than once: pass a materialized
    table when it is expensive to derive."""
    if not radius > 0:
        raise ValueError("radius must be positive")
    keys = [key] if isinstance(key, str) else list(key)
    return _nearest(positions, sites, keys, lat, lon, site_lat, site_lon, dist_col, cell, "ties",
                    distinct_sites, radius=float(radius))


def auto_cell(n: int, lat0: float, lat1: float, lon0: float, lon1: float) -> float:
    """Base cell width: about 1.5x the mean site spacing, so a 3x3 block holds
    a couple of dozen sites on average."""
    span = max(lat1 - lat0, lon1 - lon0)
    if not span > 0:
        return 1.0
    return 1.5 * span / math.sqrt(max(n, 1))


CELL_CAP = 64       # most sites one automatic cell may hold
CELL_STEPS = 8      # widths measured by one aggregate: one and its halvings


def site_profile(st: DataFrame, site_lat: str, site_lon: str) -> dict:
    """One small aggregate over the sites (a dimension table): row count and
    bounding box."""
    r = st.agg(F.count(F.lit(1)).alias("n"),
               F.min(site_lat).alias("lat0"), F.max(site_lat).alias("lat1"),
               F.min(site_lon).alias("lon0"), F.max(site_lon).alias("lon1")).first()
    return r.asDict()


def base_cell(st: DataFrame, site_lat: str, site_lon: str, profile: dict,
              cap: int = CELL_CAP, steps: int = CELL_STEPS) -> float:
    """The power of two nearest to :func:`auto_cell` (in log scale), halved
    until its densest cell holds at most ``cap`` sites, however far a stray site
    stretches the bounding box.  One aggregate measures ``steps`` widths.  Where
    halving no longer thins the densest cell, its sites coincide and the widest
    such width is taken.  (The width only changes how much work the search
    does, never its result.)"""
    start = auto_cell(profile["n"], profile["lat0"], profile["lat1"], profile["lon0"], profile["lon1"])
    top = round(math.log2(start))
    if profile["n"] <= cap:
        return 2.0 ** top
    pts = st.select(F.col(site_lat).alias("_a"), F.col(site_lon).alias("_b"))
    largest = max(abs(profile[k]) for k in ("lat0", "lat1", "lon0", "lon1"))
    finest = round(math.log2(max(largest, 1e-300))) - 50  # finer cells tell no doubles apart
    seen: dict[int, int] = {}
    while top > finest:
        ks = list(range(top, max(top - steps, finest - 1), -1))
        lv = pts.select("*", F.explode(F.array(*[F.lit(k) for k in ks])).alias("_k"))
        size = F.pow(F.lit(2.0), F.col("_k"))
        occ = (lv.groupBy("_k", grid_cell("_a", size), grid_cell("_b", size)).count()
                 .groupBy("_k").agg(F.max("count").alias("_m")))
        seen |= {r["_k"]: r["_m"] for r in occ.collect()}  # one row per candidate width
        for k in ks:
            if seen[k] <= cap:
                return 2.0 ** k
        top -= steps
    least = min(seen.values(), default=0)
    return 2.0 ** max((k for k, m in seen.items() if m == least), default=top)


def _nearest(positions, sites, keys, lat, lon, site_lat, site_lon, dist_col, cell, mode,
             distinct_sites=True, radius=None):
    """Exact two-phase search; ``mode="ties"`` returns every nearest pair,
    ``mode="min"`` only ``(keys, dist_col)`` (a partial ``min`` per phase, no
    window and no de-duplication of the sites).  With ``radius`` only pairs
    strictly closer than it count."""
    pos, raw = _clean_sides(positions, sites, lat, lon, site_lat, site_lon, distinct_sites=False)
    ext = site_profile(raw, site_lat, site_lon)  # small aggregates over the sites only
    st = raw.distinct() if (mode == "ties" and distinct_sites) else raw
    rcell = radius * (1 + GUARD) if radius is not None else None
    if cell:
        c0 = float(cell)
    elif not ext["n"]:
        c0 = rcell or 1.0
    else:
        c0 = base_cell(raw, site_lat, site_lon, ext)
        c0 = c0 if rcell is None else min(c0, rcell)

    def within(df):
        return df.where(F.col(dist_col) < F.lit(radius)) if radius is not None else df

    def best(cand):
        cand = within(cand)
        if mode == "ties":
            return _rank1(cand, keys, dist_col)
        return cand.groupBy(*keys).agg(F.min(dist_col).alias(dist_col))

    # both phases start from this one frame, so Spark evaluates the positions
    # once and reuses the exchange
    pos = _with_cell(pos, c0, lat, lon)
    top0 = best(_level0(pos, st, c0, lat, lon, site_lat, site_lon, dist_col))
    r0 = c0 / (1 + GUARD)
    if not ext["n"] or (radius is not None and radius <= r0):
        return top0  # no sites, or the first pass already covered the whole radius
    # phase 0 runs once: its (small) result is checkpointed in the shared
    # folder, and which keys need a second pass is read off it below
    ensure_checkpoint_dir(pos.sparkSession)
    top0 = top0.checkpoint(eager=True)
    done0 = top0.where(F.col(dist_col) <= F.lit(r0))

    # keys without a candidate inside the guaranteed radius
    ub = (top0.select(*keys, F.col(dist_col).alias("_ub")) if mode == "min"
          else top0.groupBy(*keys).agg(F.min(dist_col).alias("_ub")))
    unres = (pos.join(ub, keys, "left")
                .where(F.col("_ub").isNull() | (F.col("_ub") > F.lit(r0)))
                .drop("_cx", "_cy"))
    if unres.limit(1).count() == 0:  # usual case: phase 0 resolved every key
        return top0
    far = float("inf") if radius is None else radius
    asked = unres.select(*keys, lat, lon, F.coalesce("_ub", F.lit(far)).alias("_ub")).distinct()
    near = _descend(asked, st, c0, ext, keys, lat, lon, site_lat, site_lon)
    where = [F.col(lat) == F.col("_plat"), F.col(lon) == F.col("_plon")] + [
        F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    named = near.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                        F.col(lat).alias("_plat"), F.col(lon).alias("_plon"), "_cx", "_cy")
    cand = (unres.drop("_ub").join(named, reduce(lambda a, b: a & b, where))
            .drop("_plat", "_plon", *[f"_k{i}" for i in range(len(keys))])
            .join(_with_cell(st, c0, site_lat, site_lon), ["_cx", "_cy"]).drop("_cx", "_cy")
            .withColumn(dist_col, planar_distance(lat, lon, site_lat, site_lon)))
    return done0.unionByName(best(cand))


def _descend(asked, st, c0, ext, keys, lat, lon, site_lat, site_lon) -> DataFrame:
    """The fine cells in which each asked ``(keys, lat, lon, _ub)`` may have its
    nearest site: ``asked`` with ``(_cx, _cy)``.  ``_ub`` is an upper bound of
    the key's distance, infinite if unknown."""
    spark = asked.sparkSession
    fine = materialize(spark, (
        _with_cell(st, c0, site_lat, site_lon).groupBy("_cx", "_cy").agg(
            F.min(site_lat).alias("_a0"), F.max(site_lat).alias("_a1"),
            F.min(site_lon).alias("_b0"), F.max(site_lon).alias("_b1"))), name="site-cells")
    span = fine.agg(F.max("_cx") - F.min("_cx"), F.max("_cy") - F.min("_cy")).first()
    bits = max(span).bit_length()
    levels = list(range(-(-bits // STEP_BITS) * STEP_BITS, -1, -STEP_BITS))

    def cells(level):
        """Site cells of a level with the box of their sites; a cell's number
        is the fine number without its last bits."""
        at = [F.shiftright(c, level).alias(c) for c in ("_cx", "_cy")]
        up = [F.shiftright(c, level + STEP_BITS).alias(f"{c}up") for c in ("_cx", "_cy")]
        box = [F.min("_a0").alias("_a0"), F.max("_a1").alias("_a1"),
               F.min("_b0").alias("_b0"), F.max("_b1").alias("_b1")]
        return fine.select(*at, *up, "_a0", "_a1", "_b0", "_b1").groupBy(
            "_cx", "_cy", "_cxup", "_cyup").agg(*box)

    # every asked row starts at each of the top cells, at most 2 x 2 by the choice of the level
    roots = [F.struct(F.lit(r["_cx"]).alias("_cx"), F.lit(r["_cy"]).alias("_cy"))
             for r in cells(levels[0]).select("_cx", "_cy").collect()]
    pairs = asked.select("*", F.inline(F.array(*roots)))
    for n, level in enumerate(levels):
        if n:
            pairs = pairs.withColumnsRenamed({"_cx": "_cxup", "_cy": "_cyup"}).join(
                cells(level), ["_cxup", "_cyup"]).drop("_cxup", "_cyup")
        else:
            pairs = pairs.join(cells(level).drop("_cxup", "_cyup"), ["_cx", "_cy"])
        p, q = F.col(lat), F.col(lon)
        zero = F.lit(0.0)
        least = planar_distance(F.greatest(F.col("_a0") - p, p - F.col("_a1"), zero),
                                F.greatest(F.col("_b0") - q, q - F.col("_b1"), zero), zero, zero)
        most = planar_distance(F.greatest(F.abs(p - F.col("_a0")), F.abs(p - F.col("_a1"))),
                               F.greatest(F.abs(q - F.col("_b0")), F.abs(q - F.col("_b1"))), zero, zero)
        measured = pairs.withColumns({"_near": least, "_far": most}).drop("_a0", "_a1", "_b0", "_b1")
        bound = measured.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
            F.min("_far").alias("_reach"))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
        pairs = (measured.join(bound, same)
                 .withColumn("_ub", F.least("_ub", "_reach"))
                 .where(F.col("_near") <= F.col("_ub") * F.lit(1 + 1e-9))  # rounding never drops a tie
                 .drop("_near", "_far", "_reach", *[f"_k{i}" for i in range(len(keys))]))
        if n % WRITE_EVERY == WRITE_EVERY - 1:
            pairs = materialize(spark, pairs, name="site-descent")
    return pairs.drop("_ub")


def nearest_sites(positions: DataFrame, sites: DataFrame, *,
                  key: str | list[str] = "sensor_id", lat: str = "lat", lon: str = "lon",
                  site_lat: str = "latitude", site_lon: str = "longitude",
                  dist_col: str = "dist", cell: float | None = None,
                  distinct_sites: bool = True) -> DataFrame:
    """Per key, every site at the minimum distance over all of the key's
    positions (ties kept), unbounded.  Output: position columns, site columns
    and ``dist_col``.  ``distinct_sites=False`` skips de-duplicating site
    rows (a shuffle) when the site table has a key.

    Runs two small aggregates over ``sites`` (count and bounding box; cell
    occupancy at the candidate base widths, skipped for up to 64 sites); the
    rest is lazy.  ``positions`` feeds both phases from one frame (Spark reuses the
    exchange); pass a materialized table when it is expensive to derive."""
    keys = [key] if isinstance(key, str) else list(key)
    return _nearest(positions, sites, keys, lat, lon, site_lat, site_lon, dist_col, cell, "ties",
                    distinct_sites)


def nearest_below(positions: DataFrame, sites: DataFrame, bound: str, *,
                  key: str | list[str] = "sensor_id", lat: str = "lat", lon: str = "lon",
                  site_lat: str = "latitude", site_lon: str = "longitude",
                  dist_col: str = "dist") -> DataFrame:
    """Per key, every site at minimum distance when that distance is at most the
    key's ``bound`` (a column of ``positions``, one value a key; NULL:
    unbounded).  Output: keys, ``lat``, ``lon``, site columns, ``dist_col``.

    For few sites against many keys that already know a distance: a key leaves
    the descent at the first level where no cell with sites comes within its
    bound, so only keys that these sites beat or tie meet them."""
    keys = [key] if isinstance(key, str) else list(key)
    pos, st = _clean_sides(positions.select(*keys, lat, lon, bound), sites, lat, lon, site_lat, site_lon)
    ext = site_profile(st, site_lat, site_lon)
    limit = F.coalesce(F.col(bound), F.lit(float("inf")))
    asked = pos.select(*keys, lat, lon, limit.alias("_limit"), limit.alias("_ub")).distinct()
    if not ext["n"]:  # nothing to meet
        return asked.drop("_limit", "_ub").join(st.withColumn(dist_col, F.lit(0.0)), F.lit(False))
    c0 = base_cell(st, site_lat, site_lon, ext)
    cand = (_descend(asked, st, c0, ext, keys, lat, lon, site_lat, site_lon)
            .join(_with_cell(st, c0, site_lat, site_lon), ["_cx", "_cy"]).drop("_cx", "_cy")
            .withColumn(dist_col, planar_distance(lat, lon, site_lat, site_lon))
            .where(F.col(dist_col) <= F.col("_limit")).drop("_limit"))
    return _rank1(cand, keys, dist_col)


def closest_rows(candidates: DataFrame, key: str | list[str] = "sensor_id",
                 dist_col: str = "dist") -> DataFrame:
    """Of candidate pairs the nearest ones per key, ties kept.  Nearest tables of
    parts of the positions or of the sites merge this way."""
    return _rank1(candidates, [key] if isinstance(key, str) else list(key), dist_col)


def min_distance(positions: DataFrame, sites: DataFrame, *, key: str = "sensor_id",
                 lat: str = "lat", lon: str = "lon", site_lat: str = "latitude",
                 site_lon: str = "longitude", out: str = "min_dist",
                 cell: float | None = None) -> DataFrame:
    """``(key, out)``: the smallest distance from any of the key's positions to
    any site.  Keys whose positions all lack coordinates are absent."""
    return _nearest(positions.select(key, lat, lon), sites.select(site_lat, site_lon), [key],
                    lat, lon, site_lat, site_lon, out, cell, "min")


def positions_with_min_distance(positions: DataFrame, sites: DataFrame, *,
                                key: str = "sensor_id", lat: str = "lat", lon: str = "lon",
                                site_lat: str = "latitude", site_lon: str = "longitude",
                                out: str = "min_dist", cell: float | None = None) -> DataFrame:
    """Every position with its sensor-wide minimum distance (a sensor with k
    positions yields k rows, all carrying the same minimum)."""
    md = min_distance(positions, sites, key=key, lat=lat, lon=lon, site_lat=site_lat,
                      site_lon=site_lon, out=out, cell=cell)
    return positions.join(md, key)
