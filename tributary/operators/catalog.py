"""The asset catalog as tables: duplicates, versions, transitions, reuse and lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialise

#: States and their legal successors.
LEGAL = {
    "discovered": ("fetching", "validated", "failed"),
    "fetching": ("fetched", "failed", "quarantined"),
    "fetched": ("validated", "failed", "stale", "quarantined"),
    "validated": ("harmonized", "derived", "stale"),
    "harmonized": ("derived", "stale"),
    "derived": ("stale",),
    "failed": ("fetching",),
    "stale": ("fetching", "validated", "harmonized", "derived"),
    "quarantined": (),
}
TERMINAL = ("validated", "harmonized", "derived")
IDENTITY = ("source", "version", "kind", "media_type", "checksum")


def require_rows(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, violations); a null condition is a violation."""
    good = F.coalesce(ok, F.lit(False))
    return df.filter(good), df.filter(~good)


def check_ids(df: DataFrame, key: str) -> DataFrame:
    """(key, problem, rows): null, blank, non-finite, not whole, and repeated keys."""
    kind = dict(df.dtypes)[key]
    col = F.col(key)
    problem = F.when(col.isNull(), "null")
    if kind == "string":
        problem = problem.when(F.trim(col) == "", "blank")
    elif kind in ("double", "float"):
        problem = problem.when(F.isnan(col) | (F.abs(col) == float("inf")), "not finite").when(col != F.floor(col), "not whole")
    elif kind == "boolean":
        problem = F.lit("boolean")
    each = df.groupBy(col.cast("string").alias("key"), problem.alias("problem")).agg(F.count(F.lit(1)).alias("rows"))
    return each.withColumn("problem", F.coalesce("problem", F.when(F.col("rows") > 1, "repeated"))).filter("problem IS NOT NULL")


def mark_duplicates(assets: DataFrame) -> DataFrame:
    """Add canonical_id: the first path of each identity, found by one aggregate and joined back."""
    first = assets.groupBy(*IDENTITY).agg(F.min_by("asset_id", F.struct("path", "asset_id")).alias("canonical_id"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"f.{c}")) for c in IDENTITY]
    out = assets.alias("a").join(first.alias("f"), same).select("a.*", "canonical_id")
    return out.withColumn("duplicate_of", F.when(F.col("canonical_id") != F.col("asset_id"), F.col("canonical_id")))


def upsert_latest(catalog: DataFrame, updates: DataFrame, key: str = "asset_id") -> DataFrame:
    """Updates replace rows of equal key; of several updates the one with the highest ``sequence`` holds, of equal ones the one with the greatest columns."""
    both = catalog.withColumn("sequence", F.lit(-1).cast("long")).unionByName(updates.withColumn("sequence", F.col("sequence").cast("long")))
    last = both.groupBy(key).agg(F.max(F.struct("sequence", *[c for c in catalog.columns if c != key])).alias("row"))
    return last.select(*[key if c == key else F.col(f"row.{c}").alias(c) for c in catalog.columns])


def record_run(runs: DataFrame, run: DataFrame) -> DataFrame:
    return upsert_latest(runs, run.withColumn("sequence", F.lit(0)), "run_id")


def transition_table(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([(a, b) for a, bs in LEGAL.items() for b in bs], "from_status string, to_status string")


#: Fields that a transition may not set.
PROTECTED = ("asset_id", "status")


def check_transitions(requests: DataFrame) -> DataFrame:
    """Requests (asset_id, from_status, to_status, ...) that aren't legal, or whose ``updates``, a map if there is one, set a protected field."""
    illegal = requests.join(F.broadcast(transition_table(requests).withColumn("legal", F.lit(True))), ["from_status", "to_status"], "left")
    bad = F.col("legal").isNull()
    if "updates" in requests.columns:
        bad |= F.coalesce(F.arrays_overlap(F.map_keys("updates"), F.array(*map(F.lit, PROTECTED))), F.lit(False))
    return illegal.filter(bad).drop("legal")


def inventory_report(assets: DataFrame) -> DataFrame:
    """(source, status, assets, duplicates, bytes): a row per source, per status, and the total, in one pass."""
    marked = mark_duplicates(assets)
    return marked.groupingSets([["source"], ["status"], []], "source", "status").agg(F.count(F.lit(1)).alias("assets"), F.count("duplicate_of").alias("duplicates"), F.sum("size_bytes").alias("bytes"))


def bundle_checksum(members: DataFrame) -> DataFrame:
    """(bundle_id, checksum): one member's own digest; else sha256 over sorted lines of suffix and digest."""
    line = F.concat(F.col("suffix"), F.lit("\0"), F.col("checksum"), F.lit("\n"))
    g = members.groupBy("bundle_id").agg(F.count(F.lit(1)).alias("n"), F.max("checksum").alias("one"), F.array_join(F.array_sort(F.collect_list(line)), "").alias("all"))
    return g.select("bundle_id", F.when(F.col("n") == 1, F.col("one")).otherwise(F.sha2("all", 256)).alias("checksum"))


def fingerprint(rows: DataFrame, group: str, config: str, version: str) -> DataFrame:
    """(group, fingerprint): sha256 of the distinct checksums, configuration and version; the order of rows doesn't matter.

    Sorted checksums are digested per first three digits, in 4096 buckets, then the sorted digests of the buckets, so no task gets a whole group.
    """
    bucket = rows.filter("checksum IS NOT NULL").select(group, F.substring("checksum", 1, 3).alias("bucket"), "checksum").groupBy(group, "bucket").agg(F.sha2(F.array_join(F.array_sort(F.collect_set("checksum")), ","), 256).alias("digest"))
    sums = rows.select(group).distinct().join(bucket.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("bucket", "digest"))).alias("digests")), group, "left")
    joined = F.coalesce(F.array_join(F.transform("digests", lambda d: d["digest"]), ","), F.lit(""))
    return sums.select(group, F.sha2(F.concat_ws("\n", joined, F.lit(config), F.lit(version)), 256).alias("fingerprint"))


def find_reusable(catalog: DataFrame, wanted: DataFrame, fresh: DataFrame) -> DataFrame:
    """Wanted (source, version, fingerprint) with a catalog row in a terminal state whose checksum still matches the files."""
    same = catalog.filter(F.col("status").isin(*TERMINAL)).join(fresh.select("path", F.col("checksum").alias("file_checksum")), "path")
    return wanted.join(same.filter("checksum = file_checksum").drop("file_checksum"), ["source", "version", "fingerprint"])


def plan_rebuild(catalog: DataFrame, wanted: DataFrame) -> DataFrame:
    """(output_id, action): reuse, rebuild, or stale for outputs that are wanted no more. A second unchanged run only reuses."""
    have = catalog.select("output_id", F.col("fingerprint").alias("had"))
    both = wanted.select("output_id", "fingerprint").join(have, "output_id", "full_outer")
    action = F.when(F.col("fingerprint").isNull(), "stale").when(F.col("had").eqNullSafe(F.col("fingerprint")), "reuse").otherwise("rebuild")
    return both.select("output_id", action.alias("action"))


REMOTE = ("source", "version", "uri", "path", "media_type", "license", "published", "request")


def match_identity(catalog: DataFrame, remote: DataFrame) -> DataFrame:
    """Remote rows whose whole identity equals a catalog row's; nulls equal nulls."""
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in REMOTE]
    return remote.alias("r").join(catalog.alias("c"), same).select("r.*", F.col("c.asset_id").alias("catalog_id"))


def lineage_closure(edges: DataFrame, roots: DataFrame, raw: DataFrame, known: DataFrame, depth: int = 10_000) -> DataFrame:
    """(root_id, node_id, state) of all nodes below each root; state: missing, cyclic (the node depends on itself), raw, childless or inner, the first that holds.

    Edges (asset_id, depends_on). A round joins the frontier with the edges; nodes seen before end a path, so cycles end.
    Rounds go on until the frontier is empty; more than ``depth`` levels are an error. Each round is written to the shared folder.
    """
    edges = _edges(edges)
    seen = _reached(edges, roots, depth)
    nodes = materialise(seen.select("node_id").distinct(), "nodes")
    return seen.join(_states(edges, nodes, raw, known, depth), "node_id", "left").select("root_id", "node_id", F.coalesce("state", F.lit("missing")).alias("state"))  # a null id is missing


def lineage_evidence(edges: DataFrame, roots: DataFrame, raw: DataFrame, known: DataFrame, depth: int = 10_000) -> DataFrame:
    """The rows of ``lineage_closure`` that ``gate_provenance`` judges: all that are neither raw nor inner, and each raw node below any root once, without a root.

    States are those of nodes, so nodes are reached once for all roots; pairs are followed upwards, from the nodes that don't resolve only.
    """
    edges = _edges(edges)
    nodes = materialise(_reached(edges, roots, depth, one=True).select("node_id"), "nodes")
    states = materialise(_states(edges, nodes, raw, known, depth), "states")
    open_nodes = states.filter("state NOT IN ('raw', 'inner')")
    inside = edges.join(nodes.withColumnRenamed("node_id", "asset_id"), "asset_id", "left_semi")
    upward = materialise(inside.select(F.col("depends_on").alias("asset_id"), F.col("asset_id").alias("depends_on")), "upward")
    above = materialise(_reached(upward, open_nodes.select(F.col("node_id").alias("asset_id")), depth).select(F.col("node_id").alias("root_id"), F.col("root_id").alias("node_id")), "above")  # else roots are joined to each round's table
    rooted = above.join(roots.select(F.col("asset_id").alias("root")), F.col("root_id").eqNullSafe(F.col("root")), "left_semi")
    pairs = rooted.join(open_nodes.withColumnRenamed("node_id", "node"), F.col("node_id").eqNullSafe(F.col("node"))).select("root_id", "node_id", "state")
    return pairs.unionByName(states.filter("state = 'raw'").select(F.lit(None).cast(pairs.schema["root_id"].dataType).alias("root_id"), "node_id", "state"))


def _edges(edges: DataFrame) -> DataFrame:
    return materialise(edges.select("asset_id", "depends_on").filter("depends_on IS NOT NULL").distinct(), "lineage-edges")


def _states(edges: DataFrame, nodes: DataFrame, raw: DataFrame, known: DataFrame, depth: int) -> DataFrame:
    """(node_id, state) of ``nodes``, which hold all that they depend on."""
    flag = lambda df, key, name: df.select(F.col(key).alias("node_id")).distinct().withColumn(name, F.lit(True))
    out = nodes.join(flag(known, "asset_id", "known"), "node_id", "left").join(flag(raw, "asset_id", "raw"), "node_id", "left").join(flag(edges, "asset_id", "parent"), "node_id", "left")
    out = out.join(flag(cyclic(edges.join(nodes.select(F.col("node_id").alias("asset_id")), "asset_id", "left_semi"), depth), "asset_id", "cyclic"), "node_id", "left")
    state = F.when(F.col("known").isNull(), "missing").when(F.col("cyclic"), "cyclic").when(F.col("raw").isNotNull(), "raw").when(F.col("parent").isNull(), "childless").otherwise("inner")
    return out.select("node_id", state.alias("state"))


def _reached(edges: DataFrame, roots: DataFrame, depth: int, one: bool = False) -> DataFrame:
    """(root_id, node_id): each root and all nodes below it; with ``one`` all roots count as one, the null."""
    front = seen = materialise(roots.select((F.lit(None).cast(roots.schema["asset_id"].dataType) if one else F.col("asset_id")).alias("root_id"), F.col("asset_id").alias("node_id")).distinct(), "lineage")
    same = ["node_id"] if one else ["root_id", "node_id"]
    for level in range(depth + 1):
        step = front.join(edges.withColumnRenamed("asset_id", "node_id"), "node_id").select("root_id", F.col("depends_on").alias("node_id")).distinct()
        front = materialise(step.join(seen, same, "left_anti"), "front")
        if front.isEmpty():
            return seen
        seen = seen.unionByName(front)
        if level % 8 == 7:
            seen = materialise(seen, "lineage")  # one table instead of nine
    raise RuntimeError(f"lineage is deeper than {depth} levels")


def cyclic(edges: DataFrame, depth: int = 10_000) -> DataFrame:
    """(asset_id) of the nodes of ``edges`` (asset_id, depends_on) that depend on themselves: those in a strongly connected component of several nodes, or with an edge to themselves.

    Nodes without edges out, or without edges in, are peeled off until none is left to peel. Of what remains, stretches of nodes with one edge in and one out are followed to both ends by
    doubling the step, in rounds that grow with the logarithm of their length: a stretch without end is a cycle. The rest is a graph of branching nodes, whose components are found by ``strong``.
    """
    left = materialise(edges.select("asset_id", "depends_on").distinct(), "cycles")
    own = materialise(left.filter("asset_id = depends_on").select("asset_id"), "own")
    left = materialise(left.filter("asset_id != depends_on"), "cycles")
    n = left.count()
    for _ in range(depth + 1):
        inner = left.join(left.select(F.col("asset_id").alias("depends_on")).distinct(), "depends_on", "left_semi").select("asset_id", "depends_on")
        inner = inner.join(left.select(F.col("depends_on").alias("asset_id")).distinct(), "asset_id", "left_semi")
        left = materialise(inner, "cycles", replaces=left)
        n, before = left.count(), n
        if n in (0, before):
            break
    else:
        raise RuntimeError(f"lineage is deeper than {depth} levels")
    if n == 0:
        return own
    out = left.groupBy("asset_id").agg(F.count(F.lit(1)).alias("o"), F.min("depends_on").alias("next"))
    back = left.groupBy(F.col("depends_on").alias("asset_id")).agg(F.count(F.lit(1)).alias("i"), F.min("asset_id").alias("before"))
    chain = materialise(out.join(back, "asset_id").filter("o = 1 AND i = 1").select("asset_id", "next", "before"), "chain")
    rounds = chain.count().bit_length() + 1
    ends = materialise(_followed(chain, "next", rounds).join(_followed(chain, "before", rounds), "asset_id"), "ends")  # both ends of a node's stretch
    loose = chain.select(F.col("asset_id").alias("next"))
    rings = ends.join(loose, "next", "left_semi").select("asset_id")
    stretch = ends.join(loose, "next", "left_anti")
    node = chain.select("asset_id")
    direct = left.join(node, "asset_id", "left_anti").join(node.withColumnRenamed("asset_id", "depends_on"), "depends_on", "left_anti").select("asset_id", "depends_on")
    core = direct.unionByName(stretch.select(F.col("before").alias("asset_id"), F.col("next").alias("depends_on"))).distinct()
    label = strong(materialise(core, "core"), depth)
    loops = label.groupBy("label").agg(F.count(F.lit(1)).alias("nodes")).filter("nodes > 1").select("label")
    within = label.join(loops, "label", "left_semi")
    ab = stretch.join(label.select(F.col("asset_id").alias("before"), F.col("label").alias("la")), "before").join(label.select(F.col("asset_id").alias("next"), F.col("label").alias("lb")), "next").filter("la = lb")
    both = ab.select("asset_id").unionByName(ab.filter("before = next").select(F.col("before").alias("asset_id")))
    return materialise(own.unionByName(rings).unionByName(within.select("asset_id")).unionByName(both).distinct(), "cyclic")


def _followed(chain: DataFrame, way: str, rounds: int) -> DataFrame:
    """(asset_id, way): the first node outside ``chain`` that each of its nodes leads to along ``way``, or one inside where there is none."""
    now = chain.select("asset_id", way)
    for _ in range(rounds):
        step = now.select(F.col("asset_id").alias(way), F.col(way).alias("further"))
        now = materialise(now.join(step, way, "left").select("asset_id", F.coalesce("further", way).alias(way)), "step")
    return now


def strong(edges: DataFrame, depth: int = 10_000) -> DataFrame:
    """(asset_id, label): the strongly connected component of each node, by colouring forward and backward.

    Every node takes the greatest id that leads to it; the nodes of a colour that lead back to the node of that id are its component. These leave and the rest is coloured anew. More than ``depth``
    steps in one direction are an error.
    """
    nodes = edges.select("asset_id").unionByName(edges.select(F.col("depends_on").alias("asset_id"))).distinct()
    nodes, done = materialise(nodes, "nodes"), []
    while not nodes.isEmpty():
        colour = materialise(nodes.withColumn("label", F.col("asset_id")), "colour")
        for _ in range(depth + 1):
            met = edges.join(colour, "asset_id").groupBy(F.col("depends_on").alias("asset_id")).agg(F.max("label").alias("met"))
            new = colour.join(met, "asset_id", "left").select("asset_id", F.greatest("label", F.coalesce("met", "label")).alias("label"), (F.col("met") > F.col("label")).alias("changed"))
            new = materialise(new, "colour", replaces=colour)
            colour, more = new.drop("changed"), new.filter("changed")
            colour.scratch_path = new.scratch_path
            if more.isEmpty():
                break
        else:
            raise RuntimeError(f"lineage is deeper than {depth} levels")
        front = found = materialise(colour.filter("asset_id = label"), "found")
        for _ in range(depth + 1):
            back = edges.join(front.select(F.col("asset_id").alias("depends_on"), "label"), "depends_on").select("asset_id", "label").distinct()
            front = materialise(back.join(colour, ["asset_id", "label"], "left_semi").join(found, "asset_id", "left_anti"), "front")
            if front.isEmpty():
                break
            found = materialise(found.unionByName(front), "found")
        else:
            raise RuntimeError(f"lineage is deeper than {depth} levels")
        done.append(found)
        nodes = materialise(nodes.join(found, "asset_id", "left_anti"), "nodes", replaces=nodes)
        left = nodes.select("asset_id")
        edges = materialise(edges.join(left, "asset_id", "left_semi").join(left.withColumnRenamed("asset_id", "depends_on"), "depends_on", "left_semi").select("asset_id", "depends_on"), "edges")
    out = done[0] if done else nodes.withColumn("label", F.col("asset_id"))
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def lineage_groups(closure: DataFrame) -> DataFrame:
    """(root_id, raw_ids): sorted raw ids of each product."""
    return closure.filter("state = 'raw'").groupBy("root_id").agg(F.array_sort(F.collect_set("node_id")).alias("raw_ids"))


def provenance_gaps(assets: DataFrame, fields: tuple[str, ...] = ("uri", "version", "license", "checksum", "retrieved_at")) -> DataFrame:
    """(asset_id, missing): raw assets that lack a field."""
    missing = F.filter(F.array(*[F.when(F.col(f).isNull() | (F.trim(F.col(f).cast("string")) == ""), f) for f in fields]), lambda f: f.isNotNull())
    return assets.select("asset_id", missing.alias("missing")).filter(F.size("missing") > 0)


def budget_admission(assets: DataFrame, cap: int, group: str | None = None, slots: int = 64) -> DataFrame:
    """(asset_id, size_bytes, projected, admitted) in order of id; an unknown size is refused and counts nothing.

    The running sum is in two steps, over range parts and within them, so no task gets all rows.
    """
    n = F.coalesce("size_bytes", F.lit(0))
    order = ["asset_id"]
    ranged = assets.select("asset_id", "size_bytes", *([group] if group else [])).repartitionByRange(slots, *order).withColumn("slot", F.spark_partition_id())
    ranged = materialise(ranged, "ranged")
    keys = [group] if group else []
    sums = ranged.groupBy(*keys, "slot").agg(F.sum(n).alias("s"))
    before = sums.select(*keys, "slot", (F.sum("s").over(Window.partitionBy(*(keys or [F.lit(0)])).orderBy("slot")) - F.col("s")).alias("before"))
    inner = F.sum(n).over(Window.partitionBy(*keys, "slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    out = ranged.withColumn("inner", inner).join(before, [*keys, "slot"]).withColumn("projected", F.col("before") + F.col("inner"))
    return out.select(*keys, "asset_id", "size_bytes", "projected", (F.col("size_bytes").isNotNull() & (F.col("projected") <= cap)).alias("admitted"))


def canonical_asset(assets: DataFrame, source: str) -> DataFrame:
    """The one validated raw asset of a source that is no duplicate; any other number is an error."""
    out = mark_duplicates(assets).filter((F.col("source") == source) & (F.col("kind") == "raw") & (F.col("status") == "validated") & F.col("duplicate_of").isNull())
    if (n := out.limit(2).count()) != 1:
        raise ValueError(f"{source}: {'no' if not n else 'more than one'} canonical asset")
    return out


def anti_keys(mapping: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """(key, rows): foreign keys of a mapping without a parent row."""
    return mapping.join(parent.select(key), key, "left_anti").groupBy(key).agg(F.count(F.lit(1)).alias("rows"))


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side): keys that only one side has."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def summarize_run(records: DataFrame) -> DataFrame:
    """One row: records per outcome, and completed, partial or failed."""
    counts = records.agg(*[F.count_if(F.col("outcome") == o).alias(o) for o in ("fetched", "validated", "harmonized", "derived", "reused", "failed")], F.count(F.lit(1)).alias("records"))
    return counts.withColumn("status", F.when(F.col("failed") == 0, "completed").when(F.col("failed") < F.col("records"), "partial").otherwise("failed"))
