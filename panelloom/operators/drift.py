"""Schemas that drift between files: changes of fields from one file of a feed to the next, and one unified table.

Every field of every file is profiled by mergeable value sketches (theta sketches, bounded in size), its JSON type and
its name. Fields that disappear from a file and fields that appear in it form a bipartite graph, weighted by how far
the new field goes on with the old one's values; the best matching gives the renames.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.plans.matching import best_matching
from panelloom.plans.skew import checked_lookup
from panelloom.session import shared_checkpoints

#: log2 of a sketch's nominal entries: sketches of up to 4096 distinct entries are exact, larger ones estimate.
SKETCH_BITS = 12
#: A field whose distinct values number at least this share of its file's distinct rows can identify rows.
ANCHOR_SHARE = 0.75
#: Least agreement of values, after allowing for rows that came or went, that makes a rename, and what fields of few
#: values, which agree by chance more often, need beyond it: this over the number of values.
RENAME_AT, CHANCE = 0.5, 0.2
#: Weight of the names' likeness beside the values' agreement when several renames compete.
NAME_WEIGHT = 0.02
#: Least score of a field of a file against a column of the unified layout.
UNIFY_AT = 0.35

_KINDS = ("text", "integer", "decimal", "boolean", "list", "object")


def _keyed(files: DataFrame) -> DataFrame:
    """Files whose feeds can be joined by equality: "=" and the feed, '' for the null feed."""
    return files.withColumn("feed", F.coalesce(F.concat(F.lit("="), F.col("feed")), F.lit("")))


def json_kind(shape: Column) -> Column:
    """text, integer, decimal, boolean, list or object by the schema of a variant; null for JSON null."""
    return (
        F.when(shape == "STRING", "text")
        .when(shape == "BIGINT", "integer")
        .when(shape.rlike(r"^DECIMAL\(") | shape.isin("DOUBLE", "FLOAT"), "decimal")
        .when(shape == "BOOLEAN", "boolean")
        .when(shape.startswith("ARRAY"), "list")
        .when(shape.startswith("OBJECT"), "object")
    )


def _plain(v: Column, kind: Column) -> Column:
    """A value's text, the same for a value and a list of only that value, and for 3 and 3.0."""
    inner = F.try_variant_get(v, "$[0]", "string")
    alone = F.try_variant_get(v, "$[1]", "variant").isNull() & F.try_variant_get(v, "$[0]", "variant").isNotNull()
    return F.when((kind == "list") & alone & inner.isNotNull(), inner).when(kind.isin("list", "object"), F.to_json(v)).otherwise(v.cast("string"))


def _object(payload: str = "payload") -> Column:
    """A payload's fields as a map; null for a payload that is null, no JSON object or malformed. Any name will do."""
    v = F.try_parse_json(payload)
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v.cast("map<string,variant>"))


def _cells(records: DataFrame, keep: Sequence[str]) -> DataFrame:
    """keep, name and kind of each field of each record, and _f, its value; records have their fields in _m."""
    fields = records.select(*keep, F.explode("_m").alias("name", "_f")).withColumn("_shape", F.schema_of_variant("_f"))
    return fields.withColumn("kind", json_kind(F.col("_shape"))).drop("_shape")


def schemas(files: DataFrame) -> DataFrame:
    """(feed, file_id, exported_at, fields) of each file: the name and kind of its fields; names are compared exactly.

    kind is that of most non-null values (ties: the first of text, integer, decimal, boolean, list, object), null if
    all are null. A file of which no payload has a field has an empty list, whose size is else the width of its schema.
    """
    parsed = files.select("feed", "file_id", "exported_at", F.explode_outer(_object()).alias("name", "_f")).withColumn("_shape", F.schema_of_variant("_f"))
    kind = json_kind(F.col("_shape"))
    counted = parsed.withColumn("_kind", kind).groupBy("feed", "file_id", "name").agg(F.min("exported_at").alias("_at"), *[F.count_if(F.col("_kind") == k).alias(f"_n_{k}") for k in _KINDS])
    most = F.greatest(*[F.col(f"_n_{k}") for k in _KINDS])
    kind = F.lit(None).cast("string")
    for k in reversed(_KINDS):
        kind = F.when((F.col(f"_n_{k}") == most) & (most > 0), k).otherwise(kind)
    field = F.when(F.col("name").isNotNull(), F.struct("name", kind.alias("kind")))
    return counted.groupBy("feed", "file_id").agg(F.min("_at").alias("exported_at"), F.collect_list(field).alias("fields"))


def neighbours(known: DataFrame) -> DataFrame:
    """(feed, file_id, new, prev_file, old) of each file that isn't its feed's first, by exported_at, then file_id.

    known: schemas. A feed may hold a third of all files: neighbours are found within a day, and across days by the
    days' last files, so no task sorts a whole feed.
    """
    file = F.struct("file_id", "fields")
    days = known.withColumn("_day", F.to_date("exported_at"))
    inside = Window.partitionBy("feed", "_day").orderBy("exported_at", "file_id")
    across = Window.partitionBy("feed").orderBy("_day")
    last = (
        days.groupBy("feed", "_day")
        .agg(F.max_by(file, F.struct("exported_at", "file_id")).alias("_last"))
        .select("feed", F.col("_day").alias("_d"), F.lag("_last").over(across).alias("_before"))
        .withColumnRenamed("feed", "_feed")
    )
    near = days.withColumn("_near", F.lag(file).over(inside))
    joined = near.join(last, (F.col("feed") == F.col("_feed")) & F.col("_day").eqNullSafe(F.col("_d")))
    prev = joined.withColumn("_prev", F.coalesce("_near", "_before")).where("_prev is not null")
    return prev.select("feed", "file_id", F.col("fields").alias("new"), F.col("_prev.file_id").alias("prev_file"), F.col("_prev.fields").alias("old"))


def _texts(m: Column) -> Column:
    """(name, part, kind, plain) of a record's fields that aren't null, and as parts the scalars in its objects and lists.

    A part's name is the field's and its own. Parts only identify rows: a key that moves into an object stays known.
    """
    kind = lambda v: json_kind(F.schema_of_variant(v))
    cell = lambda name, part, v: F.struct(name.alias("name"), F.lit(part).alias("part"), kind(v).alias("kind"), v.alias("v"))
    fields = F.transform(F.map_entries(m), lambda e: cell(e["key"], False, e["value"]))
    none = F.array().cast("array<struct<name:string,part:boolean,kind:string,v:variant>>")
    inside = F.transform(
        fields,
        lambda f: F.when(f["kind"] == "object", F.transform(F.map_entries(f["v"].cast("map<string,variant>")), lambda e: cell(F.concat(f["name"], F.lit("\u0001"), e["key"]), True, e["value"])))
        .when(f["kind"] == "list", F.transform(f["v"].cast("array<variant>"), lambda x, i: cell(F.concat(f["name"], F.lit("\u0001"), i.cast("string")), True, x)))
        .otherwise(none),
    )
    some = F.filter(F.concat(fields, F.flatten(inside)), lambda f: f["kind"].isNotNull() & ~(f["part"] & f["kind"].isin("list", "object")))
    return F.transform(some, lambda f: F.struct(f["name"].alias("name"), f["part"].alias("part"), f["kind"].alias("kind"), _plain(f["v"], f["kind"]).alias("plain")))


def sketched(files: DataFrame) -> DataFrame:
    """(feed, file_id, name, pairs, values): value sketches of each field of each file; no feed is null.

    values sketches the field's values, pairs its values beside those of the file's row-identifying fields and parts of
    fields; both merge map-side and are bounded in size.
    """
    records = files.select("feed", "file_id", "payload", _object().alias("_m")).where("_m is not null").select("feed", "file_id", "payload", _texts(F.col("_m")).alias("_texts"))
    per_field = records.select("feed", "file_id", F.inline("_texts")).groupBy("feed", "file_id", "name", "part").agg(F.theta_sketch_agg("plain", SKETCH_BITS).alias("values"), F.max(F.col("kind") != "boolean").alias("_any"))
    per_field = per_field.checkpoint()  # read for the row-identifying fields and for the result
    sizes = files.groupBy("feed", "file_id").agg(F.theta_sketch_agg("payload", SKETCH_BITS).alias("_size"))
    # The list of a file's row-identifying fields is bounded by the width of its schema.
    anchors = (
        per_field.join(sizes, ["feed", "file_id"])
        .where(F.col("_any") & (F.theta_sketch_estimate("values") >= ANCHOR_SHARE * F.theta_sketch_estimate("_size")))
        .groupBy("feed", "file_id")
        .agg(F.collect_set("name").alias("_anchors"))
    )
    # The records are read once more instead of joining cells with cells: a record's cells stay together.
    keyed = checked_lookup(records.drop("payload"), anchors, ["feed", "file_id"], "inner")
    keyed = keyed.select("feed", "file_id", "_texts", F.explode(F.filter("_texts", lambda e: F.array_contains("_anchors", e["name"]))).alias("_a"))
    pairs = (
        keyed.select("feed", "file_id", F.col("_a.name").alias("_an"), F.col("_a.plain").alias("_ap"), F.inline("_texts"))
        .where("not part and name <> _an")
        .groupBy("feed", "file_id", "name")
        .agg(F.theta_sketch_agg(F.concat_ws("\u0001", "_ap", "plain"), SKETCH_BITS).alias("pairs"))
    )
    return per_field.where("not part").join(pairs, ["feed", "file_id", "name"], "left").select("feed", "file_id", "name", "pairs", "values")


def schema_changes(files: DataFrame) -> DataFrame:
    """(file_id, old_name, new_name, change_kind) of each file against the one before it in its feed.

    change_kind is renamed, added, removed or type_changed. A rename needs the same type and values that go on: the
    share of the smaller field's (row, value) pairs that the other has too, over the share of rows that both files have.
    Where no field identifies rows of both files, the values alone are compared. A field that is all null has no type: it is never
    type_changed or renamed. A file of which no payload has a field has an empty schema. files: record_id, feed, file_id,
    exported_at, payload; null feeds form one feed; names may hold any signs; an empty table gives no rows; further
    columns are ignored.

    Names and types are compared first; only files beside which a field went and another of its type came are sketched.
    The pairs of files that differ (a row each, of two schemas) are checkpointed.
    """
    shared_checkpoints(files.sparkSession)
    files = _keyed(files)
    both = neighbours(schemas(files)).withColumns({"_old_names": F.col("old.name"), "_new_names": F.col("new.name")})
    both = both.select(
        "feed",
        "file_id",
        "prev_file",
        F.filter("old", lambda x: ~F.array_contains("_new_names", x["name"])).alias("gone"),
        F.filter("new", lambda x: ~F.array_contains("_old_names", x["name"])).alias("come"),
        F.filter(
            F.transform("old", lambda o: F.struct(o["name"].alias("name"), o["kind"].alias("was"), F.get(F.filter("new", lambda n: n["name"] == o["name"]), F.lit(0))["kind"].alias("kind"))),
            lambda x: x["was"].isNotNull() & x["kind"].isNotNull(),
        ).alias("kept"),
    )
    typed = F.transform(F.filter("kept", lambda x: x["was"] != x["kind"]), lambda x: x["name"])
    both = both.withColumn("typed", typed).where("size(gone) > 0 or size(come) > 0 or size(typed) > 0")
    both = both.withColumn("doubt", F.arrays_overlap(F.filter("gone.kind", lambda k: k.isNotNull()), F.filter("come.kind", lambda k: k.isNotNull()))).checkpoint()
    no_graph = F.lit(None).cast("array<struct<old:string,new:string,w:double>>").alias("graph")
    certain = both.where("not doubt").select("file_id", F.col("gone.name").alias("gone"), F.col("come.name").alias("come"), "typed", no_graph)
    doubtful = both.where("doubt")
    needed = doubtful.select("feed", F.explode(F.array("file_id", "prev_file")).alias("file_id")).distinct()
    some = checked_lookup(files, needed, ["feed", "file_id"], "left_semi")
    # One row per file; the map is bounded by the width of its schema.
    of_file = sketched(some).groupBy("feed", "file_id").agg(F.map_from_entries(F.collect_list(F.struct("name", F.struct("pairs", "values")))).alias("_at"))
    of_file = of_file.checkpoint()  # each file meets the one before it and the one after it
    seen = doubtful.join(of_file.withColumnRenamed("_at", "_new"), ["feed", "file_id"], "left").join(
        of_file.select("feed", F.col("file_id").alias("prev_file"), F.col("_at").alias("_old")), ["feed", "prev_file"], "left"
    )
    old, new = (lambda n: F.try_element_at("_old", n)), (lambda n: F.try_element_at("_new", n))
    # How much of the smaller file's rows both files have, by the fields that kept name and type.
    overlap = F.array_max(F.transform(F.filter("kept", lambda x: x["was"] == x["kind"]), lambda x: _contained(old(x["name"])["pairs"], new(x["name"])["pairs"])))
    seen = seen.withColumn("_overlap", F.coalesce(overlap, F.lit(1.0)))
    graph = F.flatten(
        F.transform(
            "gone",
            lambda o: F.transform(
                F.filter("come", lambda n: n["kind"] == o["kind"]),
                lambda n: F.struct(o["name"].alias("old"), n["name"].alias("new"), _agreement(old(o["name"]), new(n["name"]), F.col("_overlap")).alias("w")),
            ),
        )
    )
    seen = seen.withColumn("graph", graph).select("file_id", F.col("gone.name").alias("gone"), F.col("come.name").alias("come"), "typed", "graph")
    return certain.unionByName(seen).mapInPandas(_decide, "file_id bigint, old_name string, new_name string, change_kind string")


def _contained(a: Column, b: Column) -> Column:
    least = F.least(F.theta_sketch_estimate(a), F.theta_sketch_estimate(b))
    return F.when(least > 0, F.theta_sketch_estimate(F.theta_intersection(a, b)) / least).otherwise(0.0)


def _agreement(o: Column, n: Column, overlap: Column) -> Column:
    """How far a new field goes on with an old one's values; null if that is too little for a rename."""
    paired = F.when(o["pairs"].isNotNull() & n["pairs"].isNotNull() & (overlap > 0), F.least(F.lit(1.0), _contained(o["pairs"], n["pairs"]) / F.greatest(overlap, F.lit(0.2))))
    agreed = F.coalesce(paired, _contained(o["values"], n["values"]))
    values = F.least(F.theta_sketch_estimate(o["values"]), F.theta_sketch_estimate(n["values"]))
    return F.when(agreed >= RENAME_AT + CHANCE / F.greatest(values, F.lit(1.0)), agreed)


def name_tokens(name: str) -> set[str]:
    """Words of a field name: split at signs and at inner capitals, in lower case."""
    return {t for t in re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", name).lower()) if t}


def name_likeness(a: str, b: str) -> float:
    """0 to 1 by common words; a word that begins another one counts half."""
    x, y = name_tokens(a), name_tokens(b)
    if not x or not y:
        return 0.0
    same = len(x & y) + 0.5 * sum(any(p.startswith(q) or q.startswith(p) for q in y - x) for p in x - y)
    return min(1.0, same / min(len(x), len(y)))


def _decide(batches):
    for pdf in batches:
        out = []
        for file_id, gone, come, typed, graph in zip(pdf.file_id, pdf.gone, pdf.come, pdf.typed, pdf.graph, strict=True):
            gone, come = sorted(gone), sorted(come)
            weight = [[0.0] * len(come) for _ in gone]
            for edge in graph if graph is not None else ():
                if edge["w"] is not None and edge["w"] >= RENAME_AT:
                    weight[gone.index(edge["old"])][come.index(edge["new"])] = edge["w"] + NAME_WEIGHT * name_likeness(edge["old"], edge["new"])
            pairs = best_matching(weight, RENAME_AT)
            out += [(file_id, gone[i], come[j], "renamed") for i, j in pairs]
            left, right = {i for i, _ in pairs}, {j for _, j in pairs}
            out += [(file_id, x, "", "removed") for i, x in enumerate(gone) if i not in left]
            out += [(file_id, "", x, "added") for j, x in enumerate(come) if j not in right]
            out += [(file_id, x, x, "type_changed") for x in sorted(typed)]
        yield pd.DataFrame(out, columns=["file_id", "old_name", "new_name", "change_kind"])


def unify(files: DataFrame, layout: DataFrame) -> DataFrame:
    """All mapping rows as one table in the layout's columns, with record_id, feed, file_id and extras (a JSON text).

    Each field of each file is matched with the layout's columns, by equal name first, else by the best matching over
    likeness of names and share of the field's values that the column has. A field that its own file can't settle
    follows the vote of its feed's other files, then of all files, for that name. What stays unmatched goes to extras.
    Values are converted to the column's type, null if they can't be. Lists give their first element (a family's lists
    are joined), objects their name, label or column. What else a list or object holds fills a column that the row has
    no value for: a key goes to the only column that has all its words, an element to the only other column that has it
    as a value in layout. The rest, and values that can't be converted, are left in extras under the field's name.
    layout is the reviewed mapping: its size is bounded by the width of one survey, so it is broadcast.
    """
    shared_checkpoints(files.sparkSession)
    files = _keyed(files)
    columns = [(f.name, f.dataType.simpleString()) for f in layout.schema.fields]
    names = [c for c, _ in columns]
    texts = [c for c, t in columns if t != "boolean"]  # the values of a boolean say nothing
    domain = layout.agg(*[F.theta_sketch_agg(F.col(f"`{c}`").cast("string"), SKETCH_BITS).alias(f"_d{i}") for i, c in enumerate(texts)])
    cells = _cells(files.select("feed", "file_id", _object().alias("_m")), ("feed", "file_id"))
    # A field under a column's own name needs no sketch.
    other = F.when(F.col("kind").isNotNull() & ~F.col("name").isin(names), _plain(F.col("_f"), F.col("kind")))
    prof = cells.groupBy("feed", "file_id", "name").agg(F.theta_sketch_agg(other, SKETCH_BITS).alias("values"))
    scored = prof.crossJoin(F.broadcast(domain))  # one row: the sketches of the layout's columns
    share = lambda c: F.when(F.theta_sketch_estimate("values") > 0, F.theta_sketch_estimate(F.theta_intersection("values", c)) / F.theta_sketch_estimate("values")).otherwise(0.0)
    scored = scored.select("feed", "file_id", "name", F.array(*[share(f"_d{i}") for i in range(len(texts))]).alias("shares"))
    per_file = scored.groupBy("feed", "file_id").agg(F.collect_list(F.struct("name", "shares")).alias("fields"))

    def assign(batches):
        for pdf in batches:
            out = []
            for feed, file_id, fields in zip(pdf.feed, pdf.file_id, pdf.fields, strict=True):
                fields = sorted(((f["name"], list(f["shares"])) for f in fields), key=lambda f: f[0])
                out += [(feed, file_id, n, n, 2.0) for n, _ in fields if n in names]
                free = [c for c in names if c not in {n for n, _ in fields}]
                rest = [f for f in fields if f[0] not in names]
                score = [[0.55 * name_likeness(n, c) + 0.45 * (s[texts.index(c)] if c in texts else 0.0) for c in free] for n, s in rest]
                found = dict(best_matching(score, UNIFY_AT))
                out += [(feed, file_id, n, free[found[i]] if i in found else None, score[i][found[i]] if i in found else 0.0) for i, (n, _) in enumerate(rest)]
            yield pd.DataFrame(out, columns=["feed", "file_id", "name", "target", "score"])

    # A row per file and field, read several times.
    own = per_file.mapInPandas(assign, "feed string, file_id bigint, name string, target string, score double").checkpoint()
    vote = lambda *by: own.where("target is not null").groupBy(*by, "target").agg(F.sum("score").alias("s")).groupBy(*by).agg(F.max(F.struct("s", "target"))["target"].alias("_t" + str(len(by))))
    settled = (
        checked_lookup(checked_lookup(own, vote("feed", "name"), ["feed", "name"]), vote("name"), ["name"])
        .select("feed", "file_id", "name", F.when(F.col("name").isin(names), F.col("name")).otherwise(F.coalesce("_t2", "_t1", "target")).alias("target"), "score")
    )
    # Two fields of a file never share a column: the better one has it.
    best = settled.where("target is not null").groupBy("feed", "file_id", "target").agg(F.max(F.struct("score", "name"))["name"].alias("name"))
    plan = best.groupBy("feed", "file_id").agg(F.map_from_entries(F.collect_list(F.struct("target", "name"))).alias("_plan"))
    rows = files.select("record_id", "feed", "file_id", _object().alias("_m")).where("_m is not null")
    joined = checked_lookup(rows, plan, ["feed", "file_id"])

    strings = [c for c, t in columns if t == "string"]
    joined = joined.crossJoin(F.broadcast(layout.agg(*[F.collect_set(F.col(f"`{c}`")).alias(f"_in{names.index(c)}") for c in strings])))
    entry = "array<struct<key:string,value:string,home:string>>"

    def only(fits: list[tuple[str, Column]]) -> Column:
        """The name beside the only condition that holds, null if none or several do."""
        found = F.array_compact(F.array(*[F.when(fit, F.lit(c)) for c, fit in fits], F.lit(None).cast("string")))
        return F.when(F.size(found) == 1, F.get(found, F.lit(0)))

    def words(key: Column) -> Column:
        parts = F.split(F.lower(F.regexp_replace(key, "(?<=[a-z0-9])(?=[A-Z])", " ")), "[^a-z0-9]+")
        return F.filter(parts, lambda t: t != "")

    def key_home(key: Column) -> Column:
        have = words(key)
        return F.when(F.size(have) > 0, only([(c, F.size(F.array_except(have, F.array(*map(F.lit, sorted(name_tokens(c)))))) == 0) for c in names if name_tokens(c)]))

    def converted(text: Column, kind: str) -> Column:
        if kind == "string":
            return text
        if kind == "boolean":
            return F.when(F.lower(text).isin("true", "1", "yes"), True).when(F.lower(text).isin("false", "0", "no"), False)
        return text.try_cast("double").try_cast(kind)

    for i, c in enumerate(names):
        joined = joined.withColumn(f"_v{i}", F.try_element_at("_m", F.col("_plan")[c]))
    joined = joined.withColumns({f"_k{i}": json_kind(F.schema_of_variant(f"_v{i}")) for i in range(len(names))})
    parts: dict[str, Column] = {}
    for i, c in enumerate(names):
        v, k = F.col(f"_v{i}"), F.col(f"_k{i}")
        listed = F.try_variant_get(v, "$", "array<string>")
        label = [F.when(F.try_variant_get(v, f"$.{x}", "string").isNotNull(), F.lit(x)) for x in ("name", "label", "column")]
        whole_list = c.endswith("family")
        parts[f"_t{i}"] = (
            F.when(k == "list", F.array_join(listed, "_") if whole_list else F.get(listed, F.lit(0)))
            .when(k == "object", F.coalesce(*[F.try_variant_get(v, f"$.{x}", "string") for x in ("name", "label", "column")], F.to_json(v)))
            .otherwise(v.cast("string"))
        )
        held = F.map_entries(F.from_json(F.to_json(v), "map<string,string>"))
        keys = F.transform(
            F.filter(held, lambda e: F.coalesce(*label).isNotNull() & e["value"].isNotNull() & ~e["key"].eqNullSafe(F.coalesce(*label))),
            lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"), key_home(e["key"]).alias("home")),
        )
        more = F.transform(
            F.filter(F.slice(listed, 2, 1 << 30), lambda e: e.isNotNull()),
            lambda e: F.struct(F.lit(None).cast("string").alias("key"), e.alias("value"), only([(x, F.array_contains(F.col(f"_in{names.index(x)}"), e)) for x in strings if x != c]).alias("home")),
        )
        rest = F.when(k == "object", keys)
        parts[f"_r{i}"] = F.coalesce(rest if whole_list else rest.when((k == "list") & (F.size(listed) > 1), more), F.array().cast(entry))
    joined = joined.withColumns(parts).withColumn("_rest", F.concat(*[F.col(f"_r{i}") for i in range(len(names))]))
    plain = {f"_o{i}": converted(F.col(f"_t{i}"), t) for i, (_, t) in enumerate(columns)}
    joined = joined.withColumns(plain).withColumns(
        {
            f"_c{i}": F.coalesce(f"_o{i}", F.get(F.filter(F.transform(F.filter("_rest", lambda e: e["home"] == c), lambda e: converted(e["value"], t)), lambda x: x.isNotNull()), F.lit(0)))
            for i, (c, t) in enumerate(columns)
        }
    )

    def taken(e: Column) -> Column:
        """Whether a column has what a list or object held besides its text."""
        out = F.lit(False)
        for i, (c, t) in enumerate(columns):
            out = F.when(e["home"] == c, F.coalesce(converted(e["value"], t) == F.col(f"_c{i}"), F.lit(False))).otherwise(out)
        return out

    left: list[Column] = []
    for i, c in enumerate(names):
        v, k = F.col(f"_v{i}"), F.col(f"_k{i}")
        stay = F.filter(F.col(f"_r{i}"), lambda e: ~taken(e))
        some = F.when(F.size(stay) > 0, F.when(k == "object", F.to_json(F.map_from_entries(F.transform(stay, lambda e: F.struct(e["key"], e["value"]))))).otherwise(F.to_json(F.transform(stay, lambda e: e["value"]))))
        lost = k.isNotNull() & F.col(f"_o{i}").isNull() & (F.to_json(v) != "[]")
        left.append(F.struct(F.col("_plan")[c].alias("key"), F.when(lost, F.when(k.isin("list", "object"), F.to_json(v)).otherwise(v.cast("string"))).otherwise(some).alias("value")))
    used = F.coalesce(F.map_values("_plan"), F.array().cast("array<string>"))
    spare = F.map_filter(F.from_json(F.to_json("_m"), "map<string,string>"), lambda k, _: ~F.array_contains(used, k))
    extras = F.to_json(F.map_concat(spare, F.map_from_entries(F.filter(F.array(*left), lambda e: e["value"].isNotNull()))))
    feed = F.when(F.col("feed") != "", F.expr("substring(feed, 2)"))
    return joined.select("record_id", feed.alias("feed"), "file_id", *[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)], extras.alias("extras"))
