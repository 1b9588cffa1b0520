"""Functions on principals, secrets, addresses, key=value items and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobledger.functions.logs import _col, bind

# Fixed value: what a masked secret is replaced by.
MASK = "<<MASKED TOKEN>>"


def principal_user(principal: Column | str) -> Column:
    """``svc/host@DOMAIN`` and ``svc@DOMAIN`` to ``svc``."""
    return F.substring_index(F.substring_index(_col(principal), "@", 1), "/", 1)


def default_principal_user(ticket_list: Column | str) -> Column:
    """The user in a ticket listing: third blank-separated field of each line with ``Default``.

    A line without any blank counts as a whole, as ``cut`` has it.
    """
    lines = F.filter(F.split(_col(ticket_list), "\n"), lambda line: F.contains(line, F.lit("Default")))
    users = F.transform(
        lines,
        lambda line: principal_user(
            F.when(F.contains(line, F.lit(" ")), F.coalesce(F.get(F.split(line, " "), 2), F.lit("")))
            .otherwise(line)
        ),
    )
    return F.trim(F.array_join(users, "\n"))


def mask(text: Column | str, secret: Column | str) -> Column:
    """Replace every occurrence of the row's literal secret; a null or empty secret masks nothing."""
    text, secret = _col(text), _col(secret)
    return F.replace(text, F.coalesce(secret, F.lit("")), F.lit(MASK))


def split_host_port(url: Column | str, strict: bool = False) -> Column:
    """Struct (host, port, status), cut at the last colon; ``http://h`` gives (``http``, ``//h``)."""
    url = _col(url)
    port = F.substring_index(url, ":", -1)
    found = F.contains(url, F.lit(":"))
    missing = F.raise_error(F.lit("address has no colon")) if strict else F.lit("no_port")
    return F.struct(
        F.when(found, F.left(url, F.length(url) - F.length(port) - 1)).alias("host"),
        F.when(found, port).alias("port"),
        F.when(found, F.lit("ok")).otherwise(missing).alias("status"),
    )


def parse_kv(items: Column | str, strict: bool = False) -> Column:
    """Struct (conf, status): items cut at their first ``=``; of equal keys the later item wins.

    If any item has no ``=`` the map is null and the status ``no_equals``; ``strict`` raises.
    """
    failed = F.raise_error(F.lit("item has no =")) if strict else F.lit("no_equals")

    def parsed(pairs: Column) -> Column:
        bad = F.coalesce(F.exists(pairs, lambda pair: F.size(pair) < 2), F.lit(False))
        return F.struct(
            F.when(~bad, _last_wins(pairs)).alias("conf"),
            F.when(bad, failed).otherwise(F.lit("ok")).alias("status"),
        )

    return bind(F.transform(_col(items), lambda item: F.split(item, "=", 2)), parsed)


def _last_wins(pairs: Column) -> Column:
    """Map of an array of [key, value] pairs, without asking the session what to do with equal keys.

    Sorted by key and place, the last of each key is the one before another key; one sort and one
    look at the neighbour take the place of a scan for each key.
    """
    places = F.array_sort(
        F.transform(pairs, lambda pair, at: F.struct(pair[0].alias("key"), at.alias("at"), pair[1].alias("value")))
    )

    def lasts(places: Column) -> Column:
        after = F.concat(F.slice(F.transform(places, lambda p: p["key"]), 2, F.greatest(F.size(places) - 1, F.lit(0))), F.array(F.lit(None).cast("string")))
        marked = F.arrays_zip(places.alias("place"), after.alias("after"))
        kept = F.filter(marked, lambda m: m["place"].isNotNull() & (m["after"].isNull() | (m["after"] != m["place"]["key"])))
        return F.map_from_entries(
            F.transform(kept, lambda m: F.struct(m["place"]["key"], m["place"]["value"]))
        )

    return bind(places, lasts)


def merge_conf(*layers: Column | str, log_conf: bool = True) -> Column:
    """Merge ``map<string,string>`` columns, later ones winning key by key; null counts as empty.

    ``log_conf`` adds the ``spark.logConf`` entry every submission carries. Keys of a lower layer
    that the higher one has are left out before the two are put together, so no key meets itself and
    the session's policy for duplicate map keys is never asked.
    """
    layers = [_col(layer) for layer in layers]
    if log_conf:
        layers.append(F.create_map(F.lit("spark.logConf"), F.lit("true")))
    empty = F.create_map().cast("map<string,string>")
    merged = empty
    for layer in layers:
        merged = bind(
            F.struct(merged.alias("low"), F.coalesce(layer, empty).alias("high")),
            lambda both: F.map_concat(
                F.map_filter(both["low"], lambda key, _: ~F.map_contains_key(both["high"], key)), both["high"]
            ),
        )
    return merged


def request_json(*fields: Column | str) -> Column:
    """JSON object of the fields that are not null; empty lists stay."""
    return F.to_json(F.struct(*fields))


def json_get(document: Column | str, path: str, default: str | None = None) -> Column:
    """The text at a JSON path, or ``default`` where it is absent (or a JSON null)."""
    found = F.get_json_object(_col(document), path)
    return found if default is None else F.coalesce(found, F.lit(default))
