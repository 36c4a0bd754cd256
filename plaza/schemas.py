"""Explicit schemas of every table; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_S, _I, _L, _D, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()
_SS = T.ArrayType(T.StringType())

USERS = _struct(user_id=_S, username=_S, personas=_SS, subreddits=_SS)

FOLLOWS = _struct(follower_id=_S, followed_id=_S)

POSTS = _struct(
    post_id=_S, author_id=_S, subreddit=_S, title=_S, selftext=_S, content=_S,
    cleaned_content=_S, created_at=_TS, score=_I, num_comments=_I, flair=_S,
)

# A post as a platform export lands it: epoch seconds, nullable author and text.
LANDED_POSTS = _struct(
    id=_S, author=_S, subreddit=_S, title=_S, selftext=_S, created_utc=_D,
    score=_I, num_comments=_I, link_flair_text=_S,
)

EDA_ROWS = _struct(post_id=_S, subreddit=_S, content=_S, created_at=_S, score=_I, num_comments=_I)

FEED_RUNS = _struct(run_id=_S, user_id=_S, platform=_S, run_status=_S, fetched_at=_TS, notes=_S)

FEED_CACHE = _struct(
    cache_id=_S, user_id=_S, platform=_S, fetched_at=_TS,
    raw_posts=T.ArrayType(_struct(
        post_id=_S, author_id=_S, subreddit=_S, title=_S, selftext=_S, content=_S, created_at=_TS, score=_I, num_comments=_I, flair=_S)),
    summary=_S,
    topic_data=T.ArrayType(_struct(topic_index=_I, title=_S, summary=_S, bullets=_SS, keywords=_SS, post_indices=T.ArrayType(_L))),
    source_meta=T.MapType(_S, _S),
)

OUTPUTS = _struct(output_id=_S, user_id=_S, source=_S, created_at=_TS, payload_json=_S)

RUNS = _struct(user_id=_S, source=_S, last_run_at=_TS, post_count=_L, output_id=_S)

TOPICS = _struct(
    topic_id=_S, user_id=_S, source=_S, topic_index=_I, topic_title=_S,
    summary_text=_S, sample_posts=_SS, created_at=_TS,
)

POST_TOPICS = _struct(
    mapping_id=_S, user_id=_S, source=_S, post_ref=_S, topic_ref=_S, created_at=_TS,
)

ANALYSIS_STATE = _struct(user_id=_S, platform=_S, data=_S, updated_at=_TS)

# Tables that refer to users: emptied together with them.
USER_TABLES = ("live_feed_runs", "live_feed_cache")

# Core tables are dropped and recreated on reset; live tables are only created when missing.
CORE_TABLES = {"users": USERS, "follows": FOLLOWS, "posts": POSTS}
LIVE_TABLES = {
    "live_feed_runs": FEED_RUNS, "live_feed_cache": FEED_CACHE, "live_outputs": OUTPUTS,
    "live_runs": RUNS, "live_topics": TOPICS, "live_post_topic_mapping": POST_TOPICS,
    "live_analysis_state": ANALYSIS_STATE,
}
