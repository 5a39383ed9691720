"""Stage times: a JSON object in a string column, one entry per finished stage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _last_of_each_key(entries: Column) -> Column:
    """Duplicate keys are legal JSON but not a legal map to build on: the last one counts."""
    keys = F.map_keys(entries)
    is_last = lambda e, i: i == F.size(keys) - F.array_position(F.reverse(keys), e["key"])
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries).otherwise(
        F.map_from_entries(F.filter(F.map_entries(entries), is_last))
    )


def merge_stage(stage_times: Column, stage: Column, at: Column) -> Column:
    """Set ``stage`` to ``at`` and keep the other entries; text that is no JSON object is replaced.

    Entry values stay variants, so numbers, lists and nested objects come through as they were.
    """
    stamp = at.cast("variant")
    fresh = F.create_map(stage, stamp)
    known = _last_of_each_key(F.from_json(stage_times, "map<string,variant>"))
    merged = F.when(
        F.map_contains_key(known, stage),
        F.transform_values(known, lambda k, v: F.when(k == stage, stamp).otherwise(v)),
    ).when(known.isNotNull(), F.map_concat(known, fresh))
    return F.to_json(F.coalesce(merged, fresh))


def stamp_text(as_of: Column) -> Column:
    """ISO form of a time, as written into stage times."""
    return F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss")
