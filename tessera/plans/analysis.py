"""The analysis of pending shapes as one plan: reset, classify, report; then clip, delete, merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import lineage, matching, spatial, tables, unregistered


def analysed(
    pending: DataFrame,
    parcels: DataFrame,
    titles: DataFrame,
    deletions: DataFrame,
    land: DataFrame,
    places: DataFrame | None = None,
    resume: bool = False,
    first_id: int = 1,
    max_polygons: int | None = None,
    update_boundaries: bool = True,
    relations: bool = False,
) -> dict[str, DataFrame]:
    """The tables and reports after an analysis.

    pending: classified rows (those before first_id, or beyond the cap, as they
    were); summary, statistics, failed: reports; parcels, land, deletions: the
    tables, changed only with update_boundaries. Without resume, earlier results
    and deletion marks are dropped first. parcels and land can go into the next run.
    relations goes on with what the classifier fails: merges, segments, shifted
    boundaries and new numbers, which also mark parcels for deletion and are reported
    as merges_and_segments and id_changes.
    """
    if not resume:
        pending, deletions = matching.reset(pending), tables.truncated(deletions)
    rows = matching.first_of_each(pending)
    todo = rows.filter(F.col("id") >= first_id)
    if max_polygons is not None:
        done = rows.filter(F.col("id") < first_id).count()
        todo = todo.orderBy("id").limit(max(0, max_polygons - done))
    found = matching.classified(todo, parcels, titles, places)
    more = {}
    if relations:
        found, deletions, more = related(found, rows, matching.existing(parcels, titles), deletions)
    rest = rows.join(found.select("id"), "id", "left_anti")
    names = [c for c in pending.columns if c not in spatial.BOX]
    result = rest.select(*names).unionByName(found.select(*names))
    out = {
        "pending": result,
        "summary": matching.summary(result),
        "statistics": matching.statistics(found),
        "failed": failed(found, todo),
        "parcels": parcels,
        "land": land,
        "deletions": deletions,
        **more,
    }
    if update_boundaries:
        out["land"] = unregistered.renumbered(land, unregistered.clipped(land, spatial.with_box(result)))
        out["parcels"] = matching.merged(matching.without(parcels, deletions), result)
        out["deletions"] = tables.truncated(deletions)
    return out


def related(found: DataFrame, pending: DataFrame, old: DataFrame, deletions: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """Classified rows, deletion marks and reports once merges, segments, shifted boundaries and new numbers are settled."""
    new = spatial.with_box(pending)
    old = spatial.with_box(old.select("poly_id", "title_no", "geom"))
    decisions = tables.written(lineage.decided(lineage.unmatched(found), old, new))
    settled, marks = lineage.resolved(found.select("id", "poly_id", "match_type"), decisions)
    fresh = found.filter("not is_known and match_type = 'fail'").select("poly_id")
    changes = tables.written(lineage.renamed(new.join(fresh, "poly_id", "left_semi"), old, new))
    settled = settled.select("id", F.col("match_type").alias("_match"))
    rows = found.join(settled, "id").join(changes.select(F.col("new_id").alias("poly_id"), F.lit(True).alias("_renamed")), "poly_id", "left")
    # A ring that goes on under a new number overlaps its old one whole.
    match = F.when(F.col("_renamed") & (F.col("_match") == "fail"), "highOverlap").otherwise(F.col("_match"))
    rows = tables.written(rows.withColumn("match_type", match).withColumn("accepted", match.isin(*matching.ACCEPTED)).select(*found.columns))
    kept = changes.join(rows.filter("match_type = 'highOverlap'").select(F.col("poly_id").alias("new_id")), "new_id", "left_semi")
    marks = marks.unionByName(kept.select(F.col("old_id").alias("poly_id")))
    at = found.select("id", "council", F.col("new_start").alias("lng_lat"), "pct")
    report = decisions.filter(F.col("decision").isin(*lineage.CHANGES)).join(at, "id")
    return rows, tables.marked(deletions, marks), {"merges_and_segments": report, "id_changes": kept}


def failed(found: DataFrame, todo: DataFrame) -> DataFrame:
    """Failed known polygons with their overlap, offset statistics and first positions.

    Shapes of another kind, new numbers and those that had failed before are not reported.
    """
    before = todo.filter("match_type = 'fail'").select("id")
    rows = found.filter("match_type = 'fail' and is_known and geom.type = 'Polygon'").join(before, "id", "left_anti")
    return rows.select("council", "poly_id", "pct", "area_diff", "stats.*", F.col("old_start").alias("old_lng_lat"), F.col("new_start").alias("new_lng_lat"))


def is_complete(max_polygons: int | None = None, max_councils: int | None = None, after_council: str | None = None) -> bool:
    """Only a run over all councils and shapes moves the date of the parcels on."""
    return max_polygons is None and max_councils is None and after_council is None


def write_reports(out: dict[str, DataFrame], folder: str) -> None:
    """The reports as JSON: stats, failed-matches, summary, merges-and-segments (without rows unless relations were looked for) and inspire-id-changes."""
    out["statistics"].groupBy("council", "stat").agg(F.collect_list("value").alias("values")).write.json(f"{folder}/stats")
    out["failed"].write.json(f"{folder}/failed-matches")
    shown = F.format_number("n", 0).alias("count")
    out["summary"].select("match_type", shown, "pct").coalesce(1).write.json(f"{folder}/summary")
    none = out["failed"].filter("false").select("council", "poly_id")
    out.get("merges_and_segments", none).write.json(f"{folder}/merges-and-segments")
    out.get("id_changes", none).write.json(f"{folder}/inspire-id-changes")
