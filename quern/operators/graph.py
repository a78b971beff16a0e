"""Graphs as node and edge tables: validity, neighbourhoods, ranks, components."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..cluster import cut


def node_id(kind: str, c: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), c.cast("string"))


def summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    n = nodes.groupBy(F.lit("node").alias("side"), F.col("ntype").alias("kind")).agg(F.count("*").alias("n"))
    return n.unionByName(edges.groupBy(F.lit("edge").alias("side"), F.col("etype").alias("kind")).agg(F.count("*").alias("n")))


def validity(docs: DataFrame, successors: DataFrame) -> DataFrame:
    """doc_id, valid_from, valid_to, known: an interval ends where the earliest dated successor begins; it is known if its start is and,
    where it has successors, its end. docs (doc_id, valid_from), successors (doc_id, successor)."""
    starts = docs.select(F.col("doc_id").alias("successor"), F.col("valid_from").alias("s"))
    heirs = successors.distinct().join(starts, "successor", "left").groupBy("doc_id").agg(F.min("s").alias("valid_to"), F.count("*").alias("heirs"))
    known = F.col("valid_from").isNotNull() & (F.col("heirs").isNull() | F.col("valid_to").isNotNull())
    return docs.join(heirs, "doc_id", "left").select("doc_id", "valid_from", "valid_to", known.alias("known"))


def as_of(intervals: DataFrame, day: date | Column) -> DataFrame:
    """Rows valid at a day, half-open; what is not known is always in."""
    day = day if isinstance(day, Column) else F.lit(day)
    inside = (F.col("valid_from").isNull() | (F.col("valid_from") <= day)) & (F.col("valid_to").isNull() | (day < F.col("valid_to")))
    return intervals.where(~F.col("known") | inside)


def projection(edges: DataFrame) -> DataFrame:
    """a < b, weight: parallel edges of either direction counted, no loops."""
    return edges.where("src <> dst").groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(F.count("*").alias("weight"))


def expand(edges: DataFrame, seeds: DataFrame, hops: int = 1, etypes: Sequence[str] | None = None, documents: str | None = None) -> DataFrame:
    """id, hops: the nearest distance of nodes from any seed, seeds left out. Only edges of the types are walked, and only to nodes whose id
    starts with the prefix of documents, where one is given. Each hop joins its frontier only; edges and frontiers are written once."""
    if etypes is not None:
        edges = edges.where(F.col("etype").isin(*etypes))
    if documents is not None:
        edges = edges.where(F.col("src").startswith(documents) & F.col("dst").startswith(documents))
    both = cut(edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    seen = seeds.select("id", F.lit(0).alias("hops"))
    front = seen
    for h in range(1, hops + 1):
        near = front.join(both, front.id == both.src).select(F.col("dst").alias("id")).distinct()
        front = cut(near.join(seen, "id", "left_anti").withColumn("hops", F.lit(h)))
        seen = seen.unionByName(front)
    return seen.where("hops > 0")


def neighbours(edges: DataFrame, seeds: DataFrame, hops: int = 1, etypes: Sequence[str] | None = None, documents: str | None = None) -> DataFrame:
    """id, hops, etype, layer, direction: expand(), and each distinct link by which a node is reached at its nearest distance; direction
    is out where the edge leads to the node."""
    found = cut(expand(edges, seeds, hops, etypes, documents))
    own = edges if etypes is None else edges.where(F.col("etype").isin(*etypes))
    walked = own.select("src", "dst", "etype", "layer", F.lit("out").alias("direction")).unionByName(own.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "etype", "layer", F.lit("in").alias("direction")))
    depth = found.unionByName(seeds.select("id", F.lit(0).alias("hops")).distinct())
    last = depth.select(F.col("id").alias("src"), (F.col("hops") + 1).alias("hops"))
    return found.join(walked.join(last, "src").withColumnRenamed("dst", "id"), ["id", "hops"]).select("id", "hops", "etype", "layer", "direction").distinct()


def descendants(edges: DataFrame, roots: DataFrame, etype: str) -> DataFrame:
    """id, target: the nodes that an edge of the type leads to, of every root."""
    return edges.where(F.col("etype") == etype).join(roots, edges.src == roots.id, "left_semi").select(F.col("src").alias("id"), F.col("dst").alias("target")).distinct()


#: Rounds of PageRank between two writes, and the most neighbours by which nodes are compared.
ROUNDS, TWINS = 5, 8


def twins(linked: DataFrame, apart: DataFrame) -> DataFrame:
    """id, twin, n: the nodes of up to TWINS neighbours, of linked (src, dst, weight, degree), that have the same neighbours by the same weights as
    another; twin is the least of the n alike. Nodes of apart (id) have no twin."""
    few = linked.where(F.col("degree") <= TWINS).join(apart, F.col("src") == F.col("id"), "left_anti")
    near = few.groupBy("src").agg(F.sort_array(F.collect_list(F.struct("dst", "weight"))).alias("near"))
    alike = near.groupBy("near").agg(F.min("src").alias("twin"), F.count("*").alias("n")).where("n > 1")
    return near.join(alike, "near").select(F.col("src").alias("id"), "twin", "n")


def pagerank(edges: DataFrame, seeds: DataFrame, alpha: float = 0.85, rounds: int = 100, tol: float = 1e-4) -> DataFrame:
    """id, score of every node of an edge and every seed: personalized PageRank over the weighted undirected projection, until a round
    changes the scores by less than tol in sum, or for a number of rounds. What a seed without an edge holds goes back to the seeds. Seeds
    are nodes of the graph; without any there are no rows. A few rounds are one job, which keeps the scores of each, and are then written.
    Nodes alike in their neighbours have one score in every round, and each is next to all or none of another such group: the rounds are
    over one node of each group, which stands for n."""
    p = projection(edges)
    both = p.select(F.col("a").alias("src"), F.col("b").alias("dst"), "weight").unionByName(p.select(F.col("b").alias("src"), F.col("a").alias("dst"), "weight"))
    linked = cut(both.join(both.groupBy("src").agg(F.sum("weight").alias("total"), F.count("*").alias("degree")), "src"))
    seeds = cut(seeds.select("id").distinct())
    n_seeds = seeds.count()
    if not n_seeds:
        return linked.select(F.col("src").alias("id"), (F.col("weight") / F.col("total")).alias("score")).where(F.lit(False))
    same = cut(twins(linked, seeds))
    gone, first = same.where("id <> twin").select("id", "twin"), same.where("id = twin").select("id", "n")
    left = linked.join(gone.select(F.col("id").alias("src")), "src", "left_anti").join(gone.select(F.col("id").alias("dst")), "dst", "left_anti")
    left = left.join(first.withColumnRenamed("id", "src"), "src", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    step = cut(left.select("src", "dst", "n", (F.col("n") * F.col("weight") / F.col("total")).alias("share"), F.lit(False).alias("own")))
    nodes = step.select(F.col("src").alias("id"), "n").distinct()
    start = nodes.join(seeds.withColumn("p", F.lit(1.0 / n_seeds)), "id", "full").select("id", F.coalesce("n", F.lit(1)).alias("n"), F.coalesce("p", F.lit(0.0)).alias("p"))
    state = cut(start.withColumn("s0", F.col("p")))
    # a node's own row goes along with what comes to it, so that a round is one join
    step = cut(step.drop("n").unionByName(state.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(0.0).alias("share"), F.lit(True).alias("own"))))
    alone = seeds.join(nodes, "id", "left_anti").count() / n_seeds
    loose, done = alone, 0
    while True:
        size, now = min(ROUNDS, rounds - done), state
        for i in range(1, size + 1):
            leak = 1 - alpha + alpha * loose
            loose = leak * alone
            keep = [F.max(F.when(F.col("own"), F.col(c))).alias(c) for c in ("n", "p", *(f"s{k}" for k in range(i)))]
            now = now.join(step, now.id == step.src).groupBy(F.col("dst").alias("id")).agg(F.sum(F.col(f"s{i - 1}") * F.col("share")).alias("m"), *keep)
            now = now.withColumn(f"s{i}", leak * F.col("p") + alpha * F.col("m")).drop("m")
        now = cut(now)
        done += size
        change = now.agg(*[F.sum(F.col("n") * F.abs(F.col(f"s{i}") - F.col(f"s{i - 1}"))).alias(f"c{i}") for i in range(1, size + 1)]).first()
        last = next((i for i in range(1, size + 1) if (change[f"c{i}"] or 0.0) < tol), None)
        if last is not None or done >= rounds:
            scores = now.select("id", F.col(f"s{last or size}").alias("score"))
            return scores.unionByName(gone.join(scores.withColumnRenamed("id", "twin"), "twin").select("id", "score"))
        state = now.select("id", "n", "p", F.col(f"s{size}").alias("s0"))


def ranked(edges: DataFrame, seeds: DataFrame, k: int = 10, documents: str = "doc:", **more: float) -> DataFrame:
    """The k best nodes by pagerank() whose id starts with the prefix, seeds left out; ties by id."""
    scores = pagerank(edges, seeds, **more).join(seeds, "id", "left_anti").where(F.col("id").startswith(documents))
    return scores.orderBy(F.desc("score"), "id").limit(k)


def min_label_components(edges: DataFrame) -> DataFrame:
    """id, component: labels spread by one hop a round until none changes; for graphs of small diameter."""
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    label = cut(both.groupBy(F.col("src").alias("id")).agg(F.least(F.min("dst"), F.first("src")).alias("component")))
    while True:
        near = both.join(label, both.dst == label.id).groupBy("src").agg(F.min("component").alias("m"))
        spread = F.least("component", F.coalesce("m", "component"))
        label = cut(label.join(near, label.id == near.src, "left").select("id", spread.alias("component"), (spread < F.col("component")).alias("changed")))
        if not label.where("changed").limit(1).count():
            return label.select("id", "component")


def successors_by_order(df: DataFrame, key: str, order: str, id_col: str) -> DataFrame:
    """doc_id, successor: the next row of the same key."""
    w = Window.partitionBy(key).orderBy(order, id_col)
    return df.select(F.col(id_col).alias("doc_id"), F.lead(id_col).over(w).alias("successor")).where("successor is not null")


def build(records: DataFrame, jurisdictions: DataFrame, cites: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, ntype, label, level) and edges (src, dst, etype, layer, rule, identifier) of records (id, title, issuer, patterns, topics, geo_scope,
    entity_id, relations), blocs (bloc, label, iso2) and citations (source_id, target_id, identifier, rule). A bloc is a node only if a record
    applies to one of its members; of several labels of a node the least is kept. What is curated is in layer L0, citations are in L1."""
    doc = node_id("doc", F.col("id"))
    national = records.where("geo_scope = 'national'").select(doc.alias("src"), F.lower("entity_id").alias("iso2"))
    seen = national.select("iso2").distinct()
    members = jurisdictions.select("bloc", "label", F.lower("iso2").alias("iso2")).join(seen, "iso2", "left_semi")
    named = lambda kind, column: records.select(doc.alias("src"), F.explode(F.array_distinct(column)).alias("x")).select("src", node_id(kind, F.col("x")).alias("dst"), F.col("x").alias("label"))
    issued = records.select(doc.alias("src"), node_id("issuer", F.col("issuer")).alias("dst"), F.col("issuer").alias("label"))
    patterns, topics = named("pattern", "patterns"), named("topic", "topics")
    node = lambda df, i, kind, label, level=None: df.select(i.alias("id"), F.lit(kind).alias("ntype"), label.alias("label"), F.lit(level).cast("string").alias("level"))
    nodes = [
        node(records, doc, "document", F.col("title")), node(issued, F.col("dst"), "issuer", F.col("label")), node(patterns, F.col("dst"), "pattern", F.col("label")),
        node(topics, F.col("dst"), "topic", F.col("label")), node(seen, node_id("country", F.col("iso2")), "jurisdiction", F.upper("iso2"), "country"), node(members, node_id("bloc", F.col("bloc")), "jurisdiction", F.col("label"), "bloc"),
    ]
    null = F.lit(None).cast("string")
    edge = lambda df, src, dst, etype, layer="L0", rule=null, identifier=null: df.select(src.alias("src"), dst.alias("dst"), etype.alias("etype"), F.lit(layer).alias("layer"), rule.alias("rule"), identifier.alias("identifier"))
    related = records.select(doc.alias("src"), F.explode("relations").alias("r"))
    c = F.col
    edges = [
        edge(issued, c("src"), c("dst"), F.lit("published_by")), edge(patterns, c("src"), c("dst"), F.lit("exemplifies")), edge(topics, c("src"), c("dst"), F.lit("about")),
        edge(national, c("src"), node_id("country", c("iso2")), F.lit("applies_to")), edge(members, node_id("country", c("iso2")), node_id("bloc", c("bloc")), F.lit("member_of")),
        edge(related, c("src"), node_id("doc", c("r.target")), c("r.type")), edge(cites, node_id("doc", c("source_id")), node_id("doc", c("target_id")), F.lit("cites"), "L1", c("rule"), c("identifier")),
    ]
    union = lambda parts: parts[0] if len(parts) == 1 else union(parts[:-1]).unionByName(parts[-1])
    return union(nodes).groupBy("id").agg(F.min(F.struct("ntype", "label", "level")).alias("n")).select("id", "n.ntype", "n.label", "n.level"), union(edges)


def validity_warnings(docs: DataFrame, successors: DataFrame) -> DataFrame:
    """doc_id, warning: several successors, and intervals that end before they begin."""
    heirs = successors.distinct().groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit("several successors").alias("warning"))
    odd = validity(docs, successors).where("valid_to < valid_from").select("doc_id", F.lit("ends before it begins").alias("warning"))
    return heirs.unionByName(odd)
