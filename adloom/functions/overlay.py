"""Ranked JSON documents of one row, read as the one document that merging them would give.

The documents are kept as layers: an array of VARIANT objects, strongest first. A path is looked up in one layer after the other; the
first that defines it decides, and a layer with anything but an object on the way hides the ones below it. An object is again layers,
so nothing is merged before a value is asked for, and nothing leaves the row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adloom.functions.jsonx import is_object
from adloom.functions.text import let

NO_LAYERS = "array<variant>"
_ENTRY = "array<struct<path:array<string>,objs:array<variant>,leaf:string>>"


def layers(documents: Column) -> Column:
    """Layers out of documents, strongest first; anything but an object at the top counts for nothing."""
    return F.coalesce(F.filter(documents, is_object), F.array().cast(NO_LAYERS))


def _defined(found: Column) -> Column:
    return F.filter(found, lambda v: v.isNotNull())


def _values(objs: Column, path: str) -> Column:
    """The values that the layers themselves have at a path, strongest first, with the layers hidden by an upper step left out."""
    first, _, rest = path.partition(".")
    here = _defined(F.transform(objs, lambda o: F.try_variant_get(o, f"$.{first}", "variant")))
    return let(let(here, _objects), lambda below: _values(below, rest)) if rest else here


def _objects(values: Column) -> Column:
    """The objects in front of the first value that is none."""
    stop = F.array_position(F.transform(values, is_object), False)
    return F.when(stop == 0, values).otherwise(F.slice(values, 1, F.greatest(stop.cast("int") - 1, F.lit(0))))


def below(objs: Column, path: str) -> Column:
    """Layers of the object at a path; none if there is no object."""
    return let(_values(objs, path), _objects)


def value(objs: Column, path: str) -> Column:
    """VARIANT that decides at a path; of a merged object its strongest layer."""
    return F.get(_values(objs, path), F.lit(0))


def text(objs: Column, path: str) -> Column:
    """Value at a path as text, a merged object as JSON; NULL for JSON null and undefined paths."""

    def told(values: Column) -> Column:
        return let(F.get(values, F.lit(0)), lambda v: F.when(is_object(v), merged_json(_objects(values))).otherwise(F.try_variant_get(v, "$", "string")))

    return let(_values(objs, path), told)


def _children(objs: Column) -> Column:
    """Members of an object as `{key, values}`, by key, the values strongest first."""
    maps = F.transform(objs, lambda o: F.try_variant_get(o, "$", "map<string,variant>"))

    def by_key(ms: Column) -> Column:
        keys = F.array_sort(F.array_distinct(F.flatten(F.transform(ms, F.map_keys))))
        return F.transform(keys, lambda k: F.struct(k.alias("key"), _defined(F.transform(ms, lambda m: F.try_element_at(m, k))).alias("values")))

    return let(maps, by_key)


def members(objs: Column) -> Column:
    """Top-level members as `{key, value, json}`: the deciding value and, merged objects included, its JSON text."""

    def told(c: Column) -> Column:
        first = F.get(c["values"], F.lit(0))
        json = F.when(is_object(first), merged_json(_objects(c["values"]))).otherwise(F.coalesce(F.to_json(first), F.lit("null")))
        return F.struct(c["key"].alias("key"), first.alias("value"), json.alias("json"))

    return F.transform(_children(objs), told)


def by_key(objs: Column) -> Column:
    """Map of every member to the values that the layers have for it, strongest first: what `first` and `objects` read."""
    return F.map_from_entries(F.transform(_children(objs), lambda c: F.struct(c["key"], c["values"])))


def first(members: Column, key: Column) -> Column:
    """The value that decides for a member, out of `by_key`."""
    return F.get(F.try_element_at(members, key), F.lit(0))


def objects(members: Column, key: Column) -> Column:
    """Layers of a member that is an object, out of `by_key`; none for anything else."""
    return F.coalesce(_objects(F.try_element_at(members, key)), F.array().cast(NO_LAYERS))


def texts(members: Column, keys: list[str], filled: bool = False) -> Column:
    """Map of the named members (of `by_key`) to their texts, a merged object as JSON; with `filled`, only of those whose text is not empty."""

    def told(c: Column) -> Column:
        v = F.get(c["value"], F.lit(0))
        return F.struct(c["key"], F.when(is_object(v), merged_json(_objects(c["value"]))).otherwise(F.try_variant_get(v, "$", "string")).alias("text"))

    told_all = F.transform(F.filter(F.map_entries(members), lambda c: c["key"].isin(keys)), told)
    return F.map_from_entries(F.filter(told_all, lambda x: x["text"] != "") if filled else told_all)


def leaves(objs: Column) -> Column:
    """`{path, value}` of every leaf of the merged document, by path; values are JSON text, an object without members is a leaf.

    Objects are opened level by level, as often as the documents are deep; what is no object rides along.
    """
    braces = F.aggregate(objs, F.lit(0), lambda n, o: n + F.regexp_count(F.to_json(o), F.lit(r"\{")))
    entry = F.struct(F.array().cast("array<string>").alias("path"), objs.alias("objs"), F.lit(None).cast("string").alias("leaf"))
    start = F.struct(F.array(entry).cast(_ENTRY).alias("entries"), (F.size(objs) > 0).alias("open"))

    def child(e: Column, c: Column) -> Column:
        return let(F.get(c["values"], F.lit(0)), lambda v: F.struct(
            F.array_append(e["path"], c["key"]).alias("path"),
            F.when(is_object(v), _objects(c["values"])).otherwise(F.array().cast(NO_LAYERS)).alias("objs"),
            F.when(~is_object(v), F.coalesce(F.to_json(v), F.lit("null"))).alias("leaf"),
        ))

    def opened(e: Column) -> Column:
        bare = F.array(F.struct(e["path"].alias("path"), F.array().cast(NO_LAYERS).alias("objs"), F.lit("{}").alias("leaf")))
        inner = let(_children(e["objs"]), lambda cs: F.when(F.size(cs) == 0, bare).otherwise(F.transform(cs, lambda c: child(e, c))))
        return F.when(F.size(e["objs"]) == 0, F.array(e)).otherwise(inner).cast(_ENTRY)

    def deeper(s: Column, _: Column) -> Column:
        grown = let(F.flatten(F.transform(s["entries"], opened)), lambda es: F.struct(es.alias("entries"), F.exists(es, lambda e: F.size(e["objs"]) > 0).alias("open")))
        return F.when(s["open"], grown).otherwise(s)

    done = F.aggregate(F.sequence(F.lit(1), F.greatest(braces, F.lit(1))), start, deeper)["entries"]
    return F.transform(F.filter(done, lambda e: e["leaf"].isNotNull()), lambda e: F.struct(e["path"].alias("path"), e["leaf"].alias("value")))


def _quoted(key: Column) -> Column:
    return F.regexp_replace(F.to_json(F.array(key)), r"^\[|\]$", "")


def merged_json(objs: Column) -> Column:
    """JSON text of the merged object, members by key; NULL without layers."""

    def shared(p: Column, q: Column) -> Column:
        steps = F.sequence(F.lit(0), F.greatest(F.least(F.size(p), F.size(q)) - 1, F.lit(0)))
        return F.aggregate(steps, F.lit(0), lambda n, i: F.when((n == i) & F.coalesce(F.get(p, i) == F.get(q, i), F.lit(False)), n + 1).otherwise(n))

    def written(ls: Column) -> Column:
        def piece(l: Column, i: Column) -> Column:
            before = F.get(ls, i - 1)["path"]

            def put(n: Column) -> Column:
                named = F.transform(F.slice(l["path"], n + 1, F.size(l["path"])), lambda k: F.concat(_quoted(k), F.lit(":")))
                up = F.when(i == 0, F.lit("{")).otherwise(F.concat(F.repeat(F.lit("}"), F.size(before) - 1 - n), F.lit(",")))
                return F.concat(up, F.array_join(named, "{"), l["value"])

            return let(F.when(i == 0, F.lit(0)).otherwise(shared(l["path"], before)), put)

        ends = F.repeat(F.lit("}"), F.size(F.element_at(ls, -1)["path"]))
        return F.when(F.size(F.get(ls, F.lit(0))["path"]) == 0, F.lit("{}")).otherwise(F.concat(F.array_join(F.transform(ls, piece), ""), ends))

    return F.when(F.size(objs) == 1, F.to_json(F.get(objs, F.lit(0)))).when(F.size(objs) > 1, let(leaves(objs), written))
