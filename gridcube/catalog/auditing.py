"""Chunk tables, holes, names, attributes, commit records."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridcube.catalog.arranging import CHUNK_SQL, SMALL, _manifest
from gridcube.catalog.registry import query
from gridcube.functions import grid, text
from gridcube.functions.fixed import BLOCK_PATTERN, LAYOUT_ATTRS, REQUIRED_ATTRS
from gridcube.functions.names import NameKey
from gridcube.operators import attrs, axes, chunks, lineage, merge
from gridcube.session import cut_lineage, fresh_dir
from gridcube.sources.tables import EVENTS_SQL, event_cells, table
from gridcube.streaming.guard import guard_stream


@query("S16 A8 P11", f"WITH {CHUNK_SQL} SELECT variable, ct, ci, cj, n_valid, nbytes FROM manifest")
def chunk_manifest(spark, folder):
    return _manifest(spark, folder)


_TWICE_SQL = CHUNK_SQL + ", twice AS (SELECT * FROM manifest UNION ALL SELECT * FROM manifest WHERE (ct + ci + cj) % 13 = 0)"


@query("A15", f"""WITH {_TWICE_SQL}, n AS (SELECT variable, ct, ci, cj, count(*) AS n FROM twice GROUP BY 1, 2, 3, 4)
    SELECT variable, CAST(sum(n) AS BIGINT) AS n_rows, count(*) FILTER (WHERE n > 1) AS n_duplicated FROM n GROUP BY 1""")
def duplicate_chunks(spark, folder):
    """Some manifest rows doubled on purpose, then found."""
    rows = _manifest(spark, folder)
    doubled = rows.where((F.col("ct") + F.col("ci") + F.col("cj")) % 13 == 0)
    return chunks.duplicate_chunks(rows.unionByName(doubled), ["variable"])


@query("X17 V5", f"WITH {CHUNK_SQL} SELECT variable, ct, ci, cj FROM manifest WHERE ct >= 28 OR ci >= 5 OR cj >= 4")
def outside_grid(spark, folder):
    """Chunks beyond a grid that is smaller than the one written."""
    return chunks.outside_grid(_manifest(spark, folder), {"ct": 28, "ci": 5, "cj": 4}).select(
        "variable", "ct", "ci", "cj"
    )


@query("X24", f"WITH {CHUNK_SQL} SELECT variable, ct, ci, cj, nbytes FROM manifest WHERE nbytes <= 4")
def degenerate_chunks(spark, folder):
    floor = int(0.2 * SMALL["time"] * SMALL["lat"] * SMALL["lon"] * 4)
    return chunks.degenerate(_manifest(spark, folder), floor).select("variable", "ct", "ci", "cj", "nbytes")


@query("A14 S17", f"""WITH {CHUNK_SQL} SELECT variable, min(nbytes) AS min_bytes, median(nbytes) AS median_bytes,
      max(nbytes) AS max_bytes, CAST(sum(nbytes) AS BIGINT) AS sum_bytes, count(*) AS n_chunks FROM manifest GROUP BY 1""")
def size_stats(spark, folder):
    return chunks.size_stats(_manifest(spark, folder), ["variable"])


@query("A19 S21", f"""WITH {CHUNK_SQL}, n AS (SELECT max(ct) + 1 AS n_days FROM manifest)
    SELECT variable, CAST(sum(nbytes) AS BIGINT) AS stored_bytes, any_value(n_days) * 36 * (max(cj) + 1) * 4 AS logical_bytes,
      round(CAST(sum(nbytes) AS BIGINT) / (any_value(n_days) * 36 * (max(cj) + 1) * 4), 6) AS ratio FROM manifest, n GROUP BY 1""")
def manifest_totals(spark, folder):
    sums = _manifest(spark, folder).groupBy("variable").agg(
        F.sum("nbytes").alias("stored_bytes"), F.max("ct").alias("_t"), F.max("cj").alias("_j")
    )
    # one row per variable of the family
    n_days = F.max("_t").over(Window.partitionBy()) + 1
    logical = (n_days * 36 * (F.col("_j") + 1) * 4).cast("long")
    return sums.withColumn("logical_bytes", logical).select(
        "variable", "stored_bytes", "logical_bytes", F.round(F.col("stored_bytes") / F.col("logical_bytes"), 6).alias("ratio")
    )


@query("A18", f"""WITH {CHUNK_SQL} SELECT variable, count(*) AS n_chunks, round(count(*) * 24.0 / 1048576, 4)::DOUBLE AS mib
    FROM manifest WHERE ct >= 5 AND ct < 15 GROUP BY 1""")
def read_cost(spark, folder):
    """Chunks under ten days, whatever part of the grid is wanted."""
    rows = _manifest(spark, folder).where("ct >= 5 and ct < 15")
    size = SMALL["time"] * SMALL["lat"] * SMALL["lon"] * 4 / 2**20
    return chunks.read_cost(rows, ["variable"], size)


_GAP_SQL = EVENTS_SQL + ", gappy AS (SELECT * FROM cells WHERE NOT (variable = 'view' AND t BETWEEN 4 AND 8))"


def _gappy(spark, folder):
    return event_cells(spark, folder).where("not (variable = 'view' and t between 4 and 8)")


@query("J8", f"""WITH {_GAP_SQL}, v AS (SELECT DISTINCT variable FROM gappy)
    SELECT variable, t FROM (SELECT variable, unnest(range((SELECT min(t) FROM gappy), (SELECT max(t) + 1 FROM gappy))) AS t FROM v)
    ANTI JOIN gappy USING (variable, t)""")
def absent_days(spark, folder):
    present = _gappy(spark, folder).select("variable", "t").distinct()
    ends = present.agg(F.min("t").alias("first"), F.max("t").alias("last")).first()
    expected = present.select("variable").distinct().select(
        "variable", F.explode(F.sequence(F.lit(ends.first), F.lit(ends.last))).alias("t")
    )
    return merge.missing_from(expected, present, ["variable", "t"])


@query("J8 W2", f"""WITH {_GAP_SQL}, holey AS (SELECT DISTINCT variable, t FROM gappy WHERE t % 11 <> 2 AND NOT (variable = 'click' AND t < 3)),
    g AS (SELECT min(t) AS a, max(t) AS b FROM gappy),
    e AS (SELECT variable, unnest(range((SELECT a FROM g), (SELECT b + 1 FROM g))) AS t FROM (SELECT DISTINCT variable FROM holey)),
    l AS (SELECT variable, t, t - row_number() OVER (PARTITION BY variable ORDER BY t) AS k FROM e ANTI JOIN holey USING (variable, t))
    SELECT variable, min(t) AS first, max(t) AS last, count(*) AS n_steps FROM l GROUP BY variable, k""")
def absent_runs(spark, folder):
    """What an axis with holes, a late start and an early end lacks of the record, as ranges."""
    gappy = _gappy(spark, folder)
    ends = gappy.agg(F.min("t").alias("a"), F.max("t").alias("b")).first()
    present = gappy.where("t % 11 <> 2 and not (variable = 'click' and t < 3)").select("variable", "t").distinct()
    found = axes.runs(present.withColumn("idx", F.col("t")), ["variable"], "t")
    return axes.absent(found, ends.a, ends.b)


@query("J9 A9", f"""WITH {EVENTS_SQL}, w AS (SELECT DISTINCT variable, i // 6 AS ci, j AS cj FROM cells WHERE NOT (variable = 'click' AND i // 6 = 2 AND j % 2 = 0)),
    g AS (SELECT min(t) AS a, max(t) AS b FROM cells),
    e AS (SELECT DISTINCT variable, i // 6 AS ci, j AS cj FROM cells, g WHERE t IN (a, (a + b) // 2, b))
    SELECT variable, ci, cj FROM e ANTI JOIN w USING (variable, ci, cj)""")
def lost_tiles(spark, folder):
    """Tiles that held data on the first, the middle or the last day and were not written."""
    tile = [F.col("variable"), grid.block(F.col("i"), 6).alias("ci"), F.col("j").alias("cj")]
    cells = event_cells(spark, folder)
    written = cells.where("not (variable = 'click' and i div 6 = 2 and j % 2 = 0)").select(*tile).distinct()
    ends = cells.agg(F.min("t").alias("a"), F.max("t").alias("b")).first()
    ever = cells.where(F.col("t").isin(ends.a, (ends.a + ends.b) // 2, ends.b)).select(*tile).distinct()
    return merge.missing_from(ever, written, ["variable", "ci", "cj"])


@query("J10 U2 S18 V6", f"""WITH {CHUNK_SQL}, v AS (SELECT DISTINCT variable FROM manifest), u AS (SELECT DISTINCT ct, ci, cj FROM manifest)
    SELECT variable, ct, ci, cj FROM (SELECT * FROM v, u) ANTI JOIN manifest USING (variable, ct, ci, cj)""")
def sibling_absent(spark, folder):
    """Chunks some sibling wrote and this variable did not.

    A chunk's writers are gathered as a set (at most the family), so no pairing of
    variables with chunks takes place.
    """
    rows = _manifest(spark, folder)
    writers = rows.groupBy("ct", "ci", "cj").agg(F.collect_set("variable").alias("w"))
    family = writers.agg(F.array_distinct(F.flatten(F.collect_set("w"))).alias("family"))  # one row
    others = F.array_except("family", "w")
    return writers.join(F.broadcast(family)).select(F.explode(others).alias("variable"), "ct", "ci", "cj")


@query("S2 S3 J11", """SELECT DISTINCT lang || '/' || n_chars // 1000 AS name FROM documents
    EXCEPT SELECT lang || '/' || n_chars // 1000 FROM documents JOIN labels USING (doc_id)""")
def missing_variables(spark, folder):
    """Names asked for, kinds of document, that have no labelled member."""
    docs = table(spark, folder, "documents").select("doc_id", F.concat_ws("/", "lang", F.expr("n_chars div 1000").cast("string")).alias("name"))
    there = docs.join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")
    return merge.missing_from(docs.select("name").distinct(), there, ["name"])


_KEY = NameKey.load()
_KEY_SQL = ", ".join(
    f"('{n}', '{r['canonical_name']}', '{r['canonical_units']}')" for n, r in _KEY.variables.items()
)
_NAMES = list(_KEY.variables)
_NAMES_SQL = "[" + ", ".join(f"'{n}'" for n in _NAMES) + "]"


@query("S25 J13 X6 X7 P10", f"""WITH k(original, canonical, units) AS (VALUES {_KEY_SQL}),
    p AS (SELECT {_NAMES_SQL}[p_partkey % 14 + 1] AS name FROM part)
    SELECT canonical, units, count(*) AS n FROM p JOIN k ON p.name = k.original GROUP BY 1, 2""")
def canonical_names(spark, folder):
    """Published names to canonical ones; an unknown name would fail the query."""
    names = F.array(*[F.lit(n) for n in _NAMES])
    named = table(spark, folder, "part").select(
        F.element_at(names, (F.col("p_partkey") % 14).cast("int") + 1).alias("name")
    )
    key = F.broadcast(_KEY.as_table(spark))  # the key file: a row per variable
    return merge.with_canonical(named, key, "name").groupBy("canonical", "units").agg(F.count(F.lit(1)).alias("n"))


@query("S25", """SELECT p_name AS canonical, count(*) AS n FROM (SELECT DISTINCT p_brand, p_name FROM part) GROUP BY 1 HAVING count(*) > 1""")
def ambiguous_names(spark, folder):
    key = table(spark, folder, "part").select(
        F.col("p_brand").alias("original"), F.col("p_name").alias("canonical")
    ).distinct()
    return merge.ambiguous_names(key)


@query("J14 O6 X14", f"""WITH {EVENTS_SQL}, g AS (SELECT variable, max(j) + 1 AS nj FROM cells GROUP BY 1)
    SELECT variable, i0, least(i0 + 10, 36) AS i1, j0, least(j0 + 2, nj) AS j1
    FROM (SELECT variable, nj, unnest(range(0, 36, 10)) AS i0 FROM g), LATERAL (SELECT unnest(range(0, nj, 2)) AS j0)""")
def block_grid(spark, folder):
    extent = event_cells(spark, folder).groupBy("variable").agg((F.max("j") + 1).cast("int").alias("nj"))
    return merge.blocks(extent, F.lit(36), F.col("nj"), 10, 2).select("variable", "i0", "i1", "j0", "j1")


_BLOCK_SQL = EVENTS_SQL + """, b AS (SELECT DISTINCT variable, i // 10 * 10 AS i0, least(i // 10 * 10 + 10, 36) AS i1, j // 2 * 2 AS j0, j // 2 * 2 + 2 AS j1 FROM cells)"""


def _blocks(spark, folder):
    i0, j0 = grid.block(F.col("i"), 10) * 10, grid.block(F.col("j"), 2) * 2
    return event_cells(spark, folder).select(
        "variable", i0.alias("i0"), F.least(i0 + 10, F.lit(36)).alias("i1"), j0.alias("j0"), (j0 + 2).alias("j1")
    ).distinct()


@query("X15 R3", f"""WITH {_BLOCK_SQL}, m AS (SELECT format('write {{}} lat[{{}}:{{}}) lon[{{}}:{{}})', variable, i0, i1, j0, j1) AS message FROM b)
    SELECT message, regexp_extract(message, '{BLOCK_PATTERN}', 1) AS variable, CAST(regexp_extract(message, '{BLOCK_PATTERN}', 2) AS BIGINT) AS i0,
      CAST(regexp_extract(message, '{BLOCK_PATTERN}', 3) AS BIGINT) AS i1, CAST(regexp_extract(message, '{BLOCK_PATTERN}', 4) AS BIGINT) AS j0,
      CAST(regexp_extract(message, '{BLOCK_PATTERN}', 5) AS BIGINT) AS j1 FROM m""")
def block_messages(spark, folder):
    rendered = _blocks(spark, folder).select(
        text.block_message(*[F.col(c) for c in ("variable", "i0", "i1", "j0", "j1")]).alias("message")
    )
    return rendered.select("message", *text.parsed_block(F.col("message")))


@query("J12", f"""WITH {_BLOCK_SQL}, d AS (SELECT * FROM b WHERE (i0 + j0) % 4 = 0),
    w AS (SELECT variable, i0, i1, j0, j1 FROM b WHERE variable <> 'error')
    SELECT 'pending' AS state, * FROM (SELECT * FROM w EXCEPT SELECT * FROM d)
    UNION ALL SELECT 'stray', * FROM (SELECT * FROM d EXCEPT SELECT * FROM w)""")
def pending_blocks(spark, folder):
    """Blocks still to write, and committed blocks the present grid does not have."""
    every = _blocks(spark, folder)
    done, wanted = every.where("(i0 + j0) % 4 = 0"), every.where("variable <> 'error'")
    bounds = ["variable", "i0", "i1", "j0", "j1"]
    pending = merge.missing_from(wanted, done, bounds).select(F.lit("pending").alias("state"), *bounds)
    stray = merge.missing_from(done, wanted, bounds).select(F.lit("stray").alias("state"), *bounds)
    return pending.unionByName(stray)


# attribute tables: a nation is an owner, its attributes are counted from its customers
_ATTR_SQL = """cust AS (SELECT CAST(c_nationkey AS VARCHAR) AS owner, c_mktsegment AS key, CAST(count(*) AS VARCHAR) AS value FROM customer GROUP BY 1, 2),
    supp AS (SELECT CAST(s_nationkey AS VARCHAR) AS owner, 'title' AS key, CAST(count(*) AS VARCHAR) AS value FROM supplier GROUP BY 1),
    here AS (SELECT * FROM cust UNION ALL SELECT * FROM supp),
    there AS (SELECT owner, key, CASE WHEN CAST(value AS BIGINT) % 3 = 0 THEN value || '*' ELSE value END AS value FROM here
      WHERE NOT (key = 'BUILDING' AND CAST(owner AS BIGINT) % 5 = 0))"""


def _attr_tables(spark, folder):
    customers = table(spark, folder, "customer").groupBy(
        F.col("c_nationkey").cast("string").alias("owner"), F.col("c_mktsegment").alias("key")
    ).agg(F.count(F.lit(1)).cast("string").alias("value"))
    suppliers = table(spark, folder, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("owner")).agg(
        F.count(F.lit(1)).cast("string").alias("value")
    ).select("owner", F.lit("title").alias("key"), "value")
    here = customers.unionByName(suppliers)
    starred = F.when(F.col("value").cast("long") % 3 == 0, F.concat("value", F.lit("*"))).otherwise(F.col("value"))
    there = here.where("not (key = 'BUILDING' and cast(owner as bigint) % 5 = 0)").withColumn("value", starred)
    return here, there


_EXEMPT_SQL = ", ".join(f"'{k}'" for k in LAYOUT_ATTRS)


@query("J16 V9 U4", f"""WITH {_ATTR_SQL} SELECT owner, key, a.value AS here, b.value AS there FROM here a FULL OUTER JOIN there b USING (owner, key)
    WHERE a.value IS DISTINCT FROM b.value AND key NOT IN ({_EXEMPT_SQL})""")
def attr_diff(spark, folder):
    here, there = _attr_tables(spark, folder)
    return attrs.differing(here, there, LAYOUT_ATTRS)


@query("U7 R8 K11 X4", f"""WITH {_ATTR_SQL}, o AS (SELECT owner, key, value, 0 AS p FROM here UNION ALL SELECT owner, key, value, 1 FROM there WHERE key <> 'title')
    SELECT owner, key, arg_max(value, p) AS value FROM o GROUP BY 1, 2""")
def attr_overlay(spark, folder):
    here, there = _attr_tables(spark, folder)
    return attrs.overlaid([here, there.where("key <> 'title'")])


@query("U5", """WITH d AS (SELECT DISTINCT source || '/' || n_chars // 100 AS owner, CASE lang WHEN 'en' THEN 'standard_name' WHEN 'fr' THEN 'long_name' WHEN 'de' THEN 'units' ELSE 'comment' END AS key FROM documents),
    n AS (SELECT DISTINCT owner, unnest(['standard_name', 'long_name', 'units']) AS key FROM d)
    SELECT owner, key FROM n ANTI JOIN d USING (owner, key)""")
def required_attrs(spark, folder):
    """Owners that lack an attribute every variable must carry."""
    key = (F.when(F.col("lang") == "en", "standard_name").when(F.col("lang") == "fr", "long_name")
           .when(F.col("lang") == "de", "units").otherwise("comment"))
    owner = F.concat_ws("/", "source", F.expr("n_chars div 100").cast("string"))
    held = table(spark, folder, "documents").select(owner.alias("owner"), key.alias("key")).distinct()
    return attrs.lacking(held, REQUIRED_ATTRS)


@query("U1 U3", f"""WITH {EVENTS_SQL}, p AS (SELECT DISTINCT variable, i, j FROM cells), a AS (SELECT i, j FROM p WHERE variable = 'view'),
      v AS (SELECT DISTINCT variable FROM p WHERE variable <> 'view'), b AS (SELECT * FROM p WHERE variable <> 'view'),
      ab AS (SELECT variable, i, j FROM v, a)
    SELECT 'both' AS side, * FROM (SELECT * FROM ab INTERSECT SELECT * FROM b)
    UNION ALL SELECT 'only here', * FROM (SELECT * FROM ab EXCEPT SELECT * FROM b)
    UNION ALL SELECT 'only there', * FROM (SELECT * FROM b EXCEPT SELECT * FROM ab)""")
def set_differences(spark, folder):
    """Footprint of view against each other variable's: intersection and both differences, from one
    pass instead of three set operations each."""
    holders = event_cells(spark, folder).groupBy("i", "j").agg(F.collect_set("variable").alias("w"))
    family = holders.agg(F.array_distinct(F.flatten(F.collect_set("w"))).alias("family"))  # one row
    others = F.explode(F.array_except("family", F.array(F.lit("view"))))
    here, there = F.array_contains("w", "view"), F.expr("array_contains(w, variable)")
    side = F.when(here & there, "both").when(here, "only here").when(there, "only there")
    sides = holders.join(F.broadcast(family)).select("i", "j", "w", others.alias("variable"))
    return sides.select(side.alias("side"), "variable", "i", "j").where("side is not null")


@query("X1", """SELECT DISTINCT 'v' || p_size || '.' || (p_partkey % 10) || chr(CAST(97 + p_partkey % 26 AS INTEGER)) AS version,
      'v_' || p_size || '_' || (p_partkey % 10) || '_' || chr(CAST(97 + p_partkey % 26 AS INTEGER)) AS directory FROM part""")
def version_dirs(spark, folder):
    letter = F.char(F.col("p_partkey") % 26 + 97)
    version = F.concat(F.lit("v"), F.col("p_size"), F.lit("."), F.col("p_partkey") % 10, letter)
    rows = table(spark, folder, "part").select(version.alias("version")).distinct()
    return rows.select("version", text.version_dir(F.col("version")).alias("directory"))


@query("X10 X11", """SELECT DISTINCT p_size AS target, p_partkey % 12 + 1 AS time_chunk,
      greatest(1, CAST(round_even(p_size / CAST(p_partkey % 12 + 1 AS DOUBLE), 0) AS BIGINT)) * (p_partkey % 12 + 1) AS batch FROM
      (SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size FROM part)""")
def commit_batches(spark, folder):
    pairs = table(spark, folder, "part").select(
        F.col("p_size").alias("target"), (F.col("p_partkey") % 12 + 1).alias("time_chunk")
    ).distinct()
    return pairs.withColumn("batch", text.commit_batch(F.col("target"), F.col("time_chunk")))


@query("X16", f"""WITH {CHUNK_SQL}, n AS (SELECT variable, max(ct) + 1 AS n_time, min(ct) + 1 AS c FROM manifest GROUP BY 1)
    SELECT variable, k AS time_chunk, CASE WHEN k >= n_time THEN 'temporal' ELSE 'spatial' END AS layout FROM n, (VALUES (CAST(1 AS BIGINT)), (10), (30)) v(k)""")
def layouts(spark, folder):
    lengths = event_cells(spark, folder).groupBy("variable").agg((F.max("t") + 1).alias("n_time"))
    sizes = F.explode(F.array(*[F.lit(k).cast("long") for k in (1, 10, 30)]))
    layout = F.when(F.col("time_chunk") >= F.col("n_time"), "temporal").otherwise("spatial")
    return lengths.select("variable", "n_time", sizes.alias("time_chunk")).select(
        "variable", "time_chunk", layout.alias("layout")
    )


@query("X22 X9", """SELECT DISTINCT upper(substr(p_name, 1, 1)) || substr(p_name, 2) || ' [' || lower(p_type) || ']' AS label FROM part""")
def axis_labels(spark, folder):
    rows = table(spark, folder, "part").select(grid.axis_label(F.col("p_name"), F.lower("p_type")).alias("label"))
    return rows.distinct()


@query("A17 X25", """SELECT o_orderstatus AS directory, count(*) AS n_objects, format('{:.2f} GiB: {} objects',
      CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS DOUBLE) * 1048576 / 1073741824, count(*)) AS summary FROM orders GROUP BY 1""")
def object_counts(spark, folder):
    """Objects per directory, with their volume as text."""
    volume = F.sum(F.round("o_totalprice").cast("long")).cast("double") * 1048576 / 1073741824
    return table(spark, folder, "orders").groupBy(F.col("o_orderstatus").alias("directory")).agg(
        F.count(F.lit(1)).alias("n_objects"),
        F.format_string("%.2f GiB: %d objects", volume, F.count(F.lit(1))).alias("summary"),
    )


_TURN_SQL = """turns AS (SELECT conv_id, turn, max(turn) OVER (PARTITION BY conv_id) - turn AS depth FROM (SELECT DISTINCT conv_id, turn FROM conversations))"""


def _commits(spark, folder):
    """Every conversation is a branch, every turn a commit on top of the one before."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn").distinct()
    name = lambda turn: F.concat_ws("/", F.col("conv_id").cast("string"), turn.cast("string"))
    parent = F.when(F.col("turn") > 0, name(F.col("turn") - 1))
    return turns.withColumn("id", name(F.col("turn"))).withColumn("parent", parent)


@query("R1 O5", f"WITH {_TURN_SQL} SELECT conv_id, turn, depth FROM turns")
def ancestry_depth(spark, folder):
    return lineage.depth_from_tip(_commits(spark, folder), "id", "parent").select("conv_id", "turn", "depth")


@query("K13 S19", f"""WITH {_TURN_SQL}, kept AS (SELECT conv_id, turn FROM turns WHERE depth >= 2)
    SELECT conv_id, turn, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM conversations
    ANTI JOIN kept USING (conv_id, turn) GROUP BY 1, 2""")
def unreachable_objects(spark, folder):
    """After a rollback by two commits: objects only the dropped commits refer to."""
    depth = lineage.depth_from_tip(_commits(spark, folder), "id", "parent")
    kept = depth.where("depth >= 2").select(F.col("id").alias("snapshot_id"))
    name = F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    objects = table(spark, folder, "conversations").withColumn("snapshot_id", name)
    return lineage.unreachable(objects, kept).groupBy("conv_id", "turn").agg(
        F.sum(F.length("text")).alias("n_chars")
    )


_TOLD_SQL = EVENTS_SQL + """, told AS (
      SELECT DISTINCT variable, t AS days, CASE WHEN variable = 'view' AND t = 12 THEN t // 5 + 1 WHEN variable = 'error' AND t = 0 THEN 2 ELSE t // 5 END AS part FROM cells
      UNION ALL SELECT DISTINCT variable, t, t // 5 + 1 FROM cells WHERE t % 7 = 3 OR (variable = 'view' AND t IN (13, 14)))"""


@query("W2", f"""WITH RECURSIVE {_TOLD_SQL}, b AS (SELECT variable, part, list(days) AS l FROM told GROUP BY 1, 2),
      f AS (SELECT variable, arg_min(list_min(l), part) AS first, min(part) AS p0 FROM b GROUP BY 1),
      parts AS (SELECT v.variable, v.first, p.part, coalesce(b.l, []) AS l, v.p0 FROM f v JOIN (SELECT DISTINCT part FROM b) p ON p.part >= v.p0
        LEFT JOIN b ON b.variable = v.variable AND b.part = p.part),
      state AS (
        SELECT variable, p0 AS part, first AS expected FROM f
        UNION ALL
        SELECT s.variable, s.part + 1, list_min(list_filter(range(s.expected, s.expected + len(p.l) + 1), lambda d: NOT list_contains(p.l, d)))
        FROM state s JOIN parts p ON p.variable = s.variable AND p.part = s.part),
      j AS (SELECT t.variable, t.part, t.days, s.expected AS e0, n.expected AS e1, p.first,
          row_number() OVER (PARTITION BY t.variable, t.part, t.days) AS again FROM told t
        JOIN state s ON s.variable = t.variable AND s.part = t.part JOIN state n ON n.variable = t.variable AND n.part = t.part + 1
        JOIN f p ON p.variable = t.variable)
    SELECT variable, part, days, CASE WHEN days < first THEN 'late' WHEN days < e0 OR (days < e1 AND again > 1) THEN 'doubled' ELSE 'early' END AS verdict
    FROM j WHERE NOT (days >= e0 AND days < e1 AND again = 1)""")
def stream_refusals(spark, folder):
    """Days of all variables arrive in parts, some of them late, early or twice; one stream for the
    family says which it refuses. Each part is one file and one micro-batch."""
    cells = event_cells(spark, folder).select("variable", F.col("t").alias("days")).distinct()
    part = F.expr("days div 5")
    moved = F.when(F.expr("variable = 'view' and days = 12"), part + 1).when(F.expr("variable = 'error' and days = 0"), F.lit(2)).otherwise(part)
    again = cells.where("days % 7 = 3 or (variable = 'view' and days in (13, 14))").withColumn("part", part + 1)
    told = cut_lineage(cells.withColumn("part", moved).unionByName(again))
    root = fresh_dir(spark, "guard")
    for r in told.select("part").distinct().orderBy("part").collect():  # the days of a record by fives
        told.where(F.col("part") == r.part).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(told.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    guard_stream(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").where("verdict <> 'accepted'").select("variable", "part", "days", "verdict")
