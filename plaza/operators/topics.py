"""Topics: how many, which post belongs to which, and the text of each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from plaza.functions import text as tx, vectors as vec
from plaza.functions.arrays import unnest
from plaza.operators import clustering, eda
from plaza.operators.keys import top_per_key
from plaza.operators.ranking import positions
from plaza.session import if_small, materialize

# Communities up to this size form one topic; the tiers of the
# topic count; characters of a topic text; posts shown per topic.
SINGLE_TOPIC_LIMIT = 20
TOPIC_TIERS = [(10, 1), (20, 2), (40, 3), (80, 4)]
TOPICS_MIN, TOPICS_MAX, POSTS_PER_TOPIC = 4, 6, 20
TOPIC_TEXT_CHARS = 3500
SAMPLE_POSTS = 3
TEXT_DIMS = 64


def num_topics(n: Column) -> Column:
    tiers = F.least(F.lit(TOPICS_MAX), F.greatest(F.lit(TOPICS_MIN), F.floor(n / POSTS_PER_TOPIC).cast("int")))
    for limit, k in reversed(TOPIC_TIERS):
        tiers = F.when(n <= limit, F.lit(k)).otherwise(tiers)
    return tiers


def topic_mode(n: Column, threshold: int = SINGLE_TOPIC_LIMIT) -> Column:
    return F.when(n <= threshold, F.lit("single")).otherwise(F.lit("cluster"))


def topic_plan(posts: DataFrame, by: Sequence[str], threshold: int = SINGLE_TOPIC_LIMIT) -> DataFrame:
    """Posts, topic count and mode per group."""
    n = F.col("n_posts")
    return posts.groupBy(*by).agg(F.count(F.lit(1)).alias("n_posts")).withColumns(
        {"num_topics": num_topics(n), "mode": topic_mode(n, threshold)})


def embed_posts(posts: DataFrame, embeddings: DataFrame, key: str) -> DataFrame:
    """Every post with its precomputed vector, null where there is none."""
    return posts.join(embeddings, key, "left")


def text_vectors(posts: DataFrame, text: str = "text", dims: int = TEXT_DIMS) -> DataFrame:
    """``embedding`` of each post from its terms, for posts that come without one: TF-IDF
    weights folded into ``dims`` places by a signed hash, of unit length. Whole texts count;
    the weights come from all posts."""
    terms = unnest(posts.select("post_id", text), ["post_id"], eda.term_list(text), "term")
    counts = terms.groupBy("post_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    used = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = posts.agg(F.count(F.lit(1))).scalar()
    weight = F.col("tf") * (F.log((total + 1.0) / (F.col("df") + 1.0)) + 1.0)
    sign = F.when(F.xxhash64(F.lit("sign"), "term") % 2 == 0, 1.0).otherwise(-1.0)
    folded = counts.join(used, "term").groupBy("post_id", F.pmod(F.xxhash64("term"), F.lit(dims)).alias("at")).agg(F.sum(weight * sign).alias("w"))
    listed = folded.groupBy("post_id").agg(F.map_from_entries(F.collect_list(F.struct("at", "w"))).alias("w"))
    places = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.coalesce(F.try_element_at("w", i.cast("long")), F.lit(0.0)))
    made = posts.select("post_id").distinct().join(listed, "post_id", "left").select(
        "post_id", F.coalesce(places, F.array_repeat(F.lit(0.0), dims)).alias("embedding"))
    length = vec.norm(F.col("embedding"))
    return made.withColumn("embedding", F.transform("embedding", lambda x: F.coalesce(F.try_divide(x, length), F.lit(0.0))))


def assign_nearest_centroid(vectors: DataFrame, centroids: DataFrame, by: Sequence[str] = (), vector: str = "embedding") -> DataFrame:
    """``topic_index`` of the nearest centroid (Euclidean, ties to the lower).

    ``centroids``: ``by..., topic_index, centroid``. A group's few centroids
    are one array, so the join adds no rows and the search is row-local.
    """
    listed = F.array_sort(F.collect_list(F.struct("topic_index", "centroid")))
    if by:
        paired = vectors.join(centroids.groupBy(*by).agg(listed.alias("_centroids")), list(by))
    else:
        paired = vectors.withColumn("_centroids", centroids.agg(listed.alias("_centroids")).scalar())
    ranked = F.transform("_centroids", lambda c: F.struct(vec.squared_distance(F.col(vector), c["centroid"]), c["topic_index"].alias("t")))
    return paired.withColumn("topic_index", F.array_min(ranked)["t"]).drop("_centroids")


def kmeans_topics(
    vectors: DataFrame, by: Sequence[str], id: str = "post_id", vector: str = "embedding",
    threshold: int = SINGLE_TOPIC_LIMIT, max_iter: int = 20, seed: int = 42,
) -> DataFrame:
    """Cluster every group with more than ``threshold`` rows, all at once.

    One fit per community would be a driver loop over communities. Here groups are blocks of rows (see
    ``clustering``): small ones are clustered in one pass, blocks of large ones make the first centroids, and up to
    ``max_iter`` Lloyd steps over all of them follow, so neither many communities nor one huge one is a bottleneck. Every
    row counts, whatever the group's size. ``id`` has to be unique within a group. Returns ``by..., id, topic_index``; topics
    that win no row do not appear.
    """
    by = list(by)
    slim = vectors.select(*by, id, F.col(vector).cast("array<double>").alias("embedding"))
    plan = topic_plan(slim, by, threshold).filter("mode = 'cluster'").select(
        *by, F.col("num_topics").alias("k"), clustering.block_count(F.col("n_posts")).alias("blocks"))
    return clustering.kmeans(slim.join(plan, by), by, id, "embedding", max_iter, seed)


def assign_topics(
    posts: DataFrame, vectors: DataFrame, by: Sequence[str], id: str = "post_id",
    threshold: int = SINGLE_TOPIC_LIMIT, text: str = "text",
) -> DataFrame:
    """``by..., id, topic_index, mode`` of every post: topic 0 in small groups, which need no
    vectors, clusters in large ones. ``vectors`` (``id, embedding``) may lack posts. A group in which
    every post has one is clustered by them; one in which some lack it, by vectors of the posts'
    texts, so that all posts of a group lie in one space."""
    by = list(by)
    plan = materialize(topic_plan(posts, by, threshold).select(*by, "mode"), "topic-plan")
    single = posts.join(plan.filter("mode = 'single'"), by).select(*by, id, F.lit(0).alias("topic_index"), "mode")
    large = materialize(embed_posts(posts.join(plan.filter("mode = 'cluster'"), by).select(*by, id, "mode"), vectors.select(id, "embedding"), id), "embedded")
    lacking = large.groupBy(*by).agg(F.max(F.col("embedding").isNull()).alias("_lacking"))
    own = large.join(lacking.filter(~F.col("_lacking")), by).select(*by, id, "embedding")
    bare = large.join(lacking.filter("_lacking"), by).select(*by, id)
    wanted = materialize(posts.join(bare.select(id).distinct(), id, "left_semi").select(id, text).dropDuplicates([id]), "bare-texts")
    made = bare.join(text_vectors(wanted.withColumnRenamed(id, "post_id"), text).withColumnRenamed("post_id", id), id).select(*by, id, "embedding")
    parts = [kmeans_topics(part, by, id, threshold=threshold) for part in (own, made)]
    clustered = parts[0].unionByName(parts[1]).withColumn("mode", F.lit("cluster"))
    return single.unionByName(clustered)


def topic_members(assigned: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The posts of every topic with their position in it, one row per post.
    A topic may be any share of the corpus, so its members stay rows."""
    return positions(assigned, by, order, "member_position")


def unique_texts(df: DataFrame, by: Sequence[str], order: Sequence[str], text: str = "text") -> DataFrame:
    """First post of each distinct text per topic, without the text itself:
    copies are told apart by digest and dropped before the shuffle."""
    slim = df.filter(F.col(text) != "").select(*by, *order, F.sha2(text, 256).alias("_digest"), tx.sentence_length(F.col(text)).alias("n_chars"))
    return top_per_key(slim, [*by, "_digest"], list(order)).drop("_digest")


def leading_rows(df: DataFrame, by: Sequence[str], order: Sequence[str], size: Column, budget: int, salts: int = 1024) -> DataFrame:
    """Rows before which less than ``budget`` of ``size`` lies, per group in order.

    What lies before a row within a slice of its group is at most what lies
    before it in the group. So each salted slice is cut first, exactly, and
    what is left per group is short enough for one window.
    """
    out = df.withColumns({"_size": size, "_salt": F.pmod(F.xxhash64(*order), F.lit(salts))})
    for keys in ([*by, "_salt"], list(by)):
        before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0))).filter(F.col("_before") < budget)
    return out.drop("_size", "_salt", "_before")


def leading_lengths(df: DataFrame, by: Sequence[str], order: Sequence[str], text: str, max_chars: int) -> DataFrame:
    """``by..., order..., n_chars`` of the posts with a text, as many per group as may reach into its first ``max_chars``.

    Texts may be dear to make, so the first ``max_chars`` posts of a group are told by their order, and only their texts are
    made. A post with a text takes two characters or more, so these do unless more than half are empty: a
    group that they neither fill nor exhaust is measured whole.
    """
    def lengths(posts: DataFrame) -> DataFrame:
        # A filter on the text would be taken below the join, and make all texts.
        return unnest(posts, [*by, *order], F.array(F.when(F.col(text) != "", tx.sentence_length(F.col(text)))), "n_chars")

    keys = df.select(*by, *order)
    first = materialize(top_per_key(keys, by, order, k=max_chars), "first-posts")
    named = if_small(first.distinct().withColumnsRenamed({c: f"_{c}" for c in keys.columns}))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys.columns]
    made = materialize(lengths(df.join(named, same, "left_semi")), "first-lengths")
    filled = made.groupBy(*by).agg(F.sum(F.col("n_chars") + 1).alias("_filled"))
    open_groups = first.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= max_chars).join(
        filled.filter(F.col("_filled") >= max_chars), by, "left_anti").select(*by)
    open_groups = materialize(open_groups, "open-groups")
    if open_groups.isEmpty():
        return made
    whole = lengths(df.join(if_small(open_groups), by, "left_semi"))
    return made.join(open_groups, by, "left_anti").unionByName(whole)


def topic_text(df: DataFrame, by: Sequence[str], order: Sequence[str], text: str = "text", unique: bool = True, max_chars: int = TOPIC_TEXT_CHARS) -> DataFrame:
    """Posts of each topic as sentences, joined in order and cut at ``max_chars``.

    ``order`` has to name a row. Only digests and lengths are shuffled to find
    the posts that reach into the first ``max_chars``; their texts follow.
    """
    by, order = list(by), list(order)
    if unique:
        lengths = unique_texts(df, by, order, text)
    else:
        lengths = leading_lengths(df, by, order, text, max_chars)
    # Written, so that where they are few they are broadcast before any text is shuffled.
    lead = materialize(leading_rows(lengths, by, order, F.col("n_chars") + 1, max_chars).select(*by, *order), "leading-posts")
    entry = F.struct(*order, tx.as_sentence(F.col(text)).alias("s"))
    # The semi-join is taken below the making of the texts.
    wanted = df.join(if_small(lead), [*by, *order], "left_semi")
    listed = wanted.join(lead, [*by, *order]).groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("_parts"))
    joined = F.array_join(F.transform("_parts", lambda p: p["s"]), " ")
    return listed.select(*by, F.substring(joined, 1, max_chars).alias("topic_text"))


def sample_posts(df: DataFrame, by: Sequence[str], order: Sequence[str], text: str = "text", unique: bool = True, k: int = SAMPLE_POSTS) -> DataFrame:
    """The first ``k`` posts of every topic, as one array of texts. Which they are is found without texts and
    written, so that where they are few they are broadcast before any text is shuffled."""
    by, order = list(by), list(order)
    rows = unique_texts(df, by, order, text) if unique else df.select(*by, *order)
    first = materialize(top_per_key(rows, by, order, k=k).select(*by, *order), "first-posts")
    entry = F.struct(*order, F.col(text).alias("s"))
    listed = df.join(first, [*by, *order]).groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("_s"))
    return listed.select(*by, F.transform("_s", lambda p: p["s"]).alias("sample_posts"))
