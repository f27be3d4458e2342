"""Documents as JSON text: keys, ids, kinds of updates and the fields that a change touched.

Top-level keys keep their order and duplicates.  Values are told apart by their JSON type through
VARIANT, never by their text, so a string that looks like a document is still a string.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NONE = "array<string>"


def keys(doc: Column) -> Column:
    """Top-level keys in order, [] if doc is no document."""
    return F.coalesce(F.json_object_keys(doc), F.array().cast(_NONE))


def has_key(doc: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(doc), key), F.lit(False))


def _values(doc: Column) -> Column:
    return F.from_json(doc, "map<string,variant>")


def _is_doc(v: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.lit(False))


# --- ids -------------------------------------------------------------------------------------------


def id_variant(doc: Column) -> Column:
    return F.from_json(doc, "_id variant")["_id"]


def id_kind(v: Column) -> Column:
    """string, oid, or unsupported."""
    s = F.schema_of_variant(v)
    oid = s.rlike("^OBJECT<`?[$]oid`?: STRING>$") & F.coalesce(F.try_variant_get(v, "$.$oid", "string").rlike("^[0-9a-f]{24}$"), F.lit(False))
    return F.when(s == "STRING", "string").when(oid, "oid").otherwise("unsupported")


def id_text(v: Column) -> Column:
    """The id in channels: the string, or an object id's hex digits; null if unsupported."""
    kind = id_kind(v)
    return F.when(kind == "string", F.try_variant_get(v, "$", "string")).when(kind == "oid", F.try_variant_get(v, "$.$oid", "string"))


# --- updates ---------------------------------------------------------------------------------------


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def is_v2(doc: Column) -> Column:
    """$v is the number 2 and there is a diff."""
    return update_kind(F.lit("u"), doc) == "v2"


def is_replacement(doc: Column) -> Column:
    """Neither $set nor $unset is a key (even with null), and it is no v2 update."""
    return update_kind(F.lit("u"), doc) == "replacement"


def update_kind(op: Column, doc: Column) -> Column:
    """v2, replacement or v1 of an update, else null; the keys are read once, $v only beside a diff."""
    number = lambda v: F.schema_of_variant(v).rlike("^(BIGINT|DOUBLE|DECIMAL.*|INT|SMALLINT|TINYINT|FLOAT)$") & (F.try_variant_get(v, "$", "double") == 2.0)
    two = F.coalesce(_let(F.from_json(doc, "`$v` variant")["$v"], number), F.lit(False))
    has = lambda ks, key: F.array_contains(ks, key)
    kind = lambda ks: F.when(has(ks, "diff") & two, "v2").when(has(ks, "$set") | has(ks, "$unset"), "v1").otherwise("replacement")
    return F.when(op == "u", _let(keys(doc), kind))


# --- changed fields --------------------------------------------------------------------------------


def _marked(fields: Column, bad: Column) -> Column:
    return F.struct(fields.cast(_NONE).alias("fields"), bad.cast("int").alias("n_bad"))


def _doc_keys(v: Column) -> Column:
    return F.when(_is_doc(v), F.json_object_keys(F.to_json(v))).otherwise(F.array().cast(_NONE))


def _of_entries(doc: Column, fields, bad) -> Column:
    """Struct (fields, n_bad) of a document whose entries (key, value) give fields(e) and may be bad(e); the document is parsed once."""
    return _let(F.map_entries(_values(doc)), lambda es: _marked(F.flatten(F.transform(es, fields)), F.size(F.filter(es, bad))))


def modifier_fields(doc: Column) -> Column:
    """Struct (fields, n_bad) of a v1 update: the keys of each modifier but $v; other values than documents count as bad."""
    return _of_entries(doc, lambda e: F.when(e["key"] != "$v", _doc_keys(e["value"])).otherwise(F.array().cast(_NONE)), lambda e: (e["key"] != "$v") & ~_is_doc(e["value"]))


def shallow_diff(diff: Column) -> Column:
    """Struct (fields, n_bad) of a v2 diff's top level."""
    crud = lambda e: e["key"].isin("i", "u", "d")
    sub = lambda e: ~crud(e) & F.startswith(e["key"], F.lit("s"))
    quiet = lambda e: (e["key"] == "a") | F.startswith(e["key"], F.lit("o"))
    one = lambda e: F.when(crud(e), _doc_keys(e["value"])).when(sub(e), F.array(F.substr(e["key"], F.lit(2)))).otherwise(F.array().cast(_NONE))
    wrong = lambda e: F.when(crud(e), ~_is_doc(e["value"])).otherwise(~sub(e) & ~quiet(e))
    return _of_entries(diff, one, wrong)


def is_array_operator(doc: Column) -> Column:
    """A document with a, and besides only keys that begin with u and a digit."""
    ks = F.json_object_keys(doc)
    return F.coalesce(F.array_contains(ks, "a") & F.forall(ks, lambda k: (k == "a") | k.rlike(r"^u[0-9]+")), F.lit(False))


_INDEX = re.compile(r"u[0-9]+")


def walk_diff(diff: dict) -> tuple[list[str], int]:
    """(dotted paths that a v2 diff touches, sorted; entries that cannot be read).

    A list of what is still to be read, not a recursion: (path so far, document, whether it is a diff).
    In a plain document, whatever is no document with keys of its own is a path; a diff names what it
    inserts, updates or deletes (i, u, d: plain documents), array places (a document that
    is_array_operator holds for) and documents below (s and the field's name: diffs).
    """
    fields, bad, todo = [], 0, [("", diff, True)]
    while todo:
        path, doc, is_diff = todo.pop()
        for k, v in doc.items():
            below = isinstance(v, dict)
            if not is_diff:
                if below and v:
                    todo.append((f"{path}{k}.", v, False))
                else:
                    fields.append(path + k)
            elif k in ("i", "u", "d") and below:
                todo.append((path, v, False))
            elif k not in ("i", "u", "d") and below and "a" in v and all(x == "a" or _INDEX.match(x) for x in v):
                fields += [f"{path}{k[1:]}.{x[1:]}" for x in v if x != "a"]
            elif k[:1] == "s" and below:
                todo.append((f"{path}{k[1:]}.", v, True))
            else:
                bad += k != "a"
    return sorted(fields), bad


DEEP = T.StructType([T.StructField("fields", T.ArrayType(T.StringType())), T.StructField("n_bad", T.IntegerType())])


@F.pandas_udf(DEEP)
def deep_diff(diffs: pd.Series) -> pd.DataFrame:
    """Struct (fields, n_bad) of v2 diffs, a batch at a time, with the paths inside documents; nulls, rows without a diff, are passed over.

    The nesting has no bound, so this is no built-in expression.
    """
    fields, bad = [[]] * len(diffs), [1] * len(diffs)
    for i, text in enumerate(diffs):
        if text is not None:
            try:
                d = json.loads(text)
            except ValueError:
                continue
            if isinstance(d, dict):
                fields[i], bad[i] = walk_diff(d)
    return pd.DataFrame({"fields": fields, "n_bad": bad})


def changed_fields(op: Column, doc: Column, deep: bool = False, kind: Column | None = None) -> Column:
    """Struct (fields, n_bad): what an insert, update or delete touched; fields is never null.

    kind: update_kind of the same, where it is a column already.
    """
    kind = update_kind(op, doc) if kind is None else kind
    diff = F.when(kind == "v2", F.get_json_object(doc, "$.diff"))
    v2 = deep_diff(diff) if deep else shallow_diff(diff)
    plain = _marked(keys(doc), F.lit(0))
    nothing = _marked(F.array(), F.lit(0))
    got = F.when((op == "i") | (kind == "replacement"), plain).when(kind == "v2", v2).when(kind == "v1", modifier_fields(doc)).otherwise(nothing)
    return _let(got, lambda c: _marked(F.coalesce(c["fields"], F.array().cast(_NONE)), F.coalesce(c["n_bad"], F.lit(1)))) if not deep else got
