"""Chains of landed pages: which pages follow which, by pointer doubling over their tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trialmart.sources.storage import materialize
from trialmart.sources.study_pages import page_studies

#: What a page is to its chain. The first that holds counts.
COPY, CYCLE, AFTER_GAP, AFTER_EMPTY, BROKEN, EMPTY, READ = (
    "copy",  # of a page that landed before
    "in or behind a cycle",
    "after a gap",  # the page that leads here did not land
    "after an empty page",  # where reading stops
    "no studies",  # an error page, or no JSON
    "empty",
    "read",
)


def page_links(pages: DataFrame) -> DataFrame:
    """One row per landed page: key, page_token (that it was asked for with; NULL for a first page),
    next_token, n_studies (NULL without a list), copy (1 for the first page of a token by file and text)."""

    def token(name: str):
        return F.try_variant_get("page", f"$.{name}", "string")

    text = F.coalesce(F.col("text"), F.to_json("page"), F.lit(""))
    links = pages.select(
        token("pageToken").alias("page_token"),
        token("nextPageToken").alias("next_token"),
        F.size(page_studies(F.col("page"))).cast("long").alias("n_studies"),
        "source_file",
        F.sha2(text.cast("binary"), 256).alias("digest"),
    )
    first = F.coalesce(F.concat(F.lit("first before "), F.col("next_token")), F.concat(F.lit("only "), F.col("digest")))
    links = links.withColumn("key", F.coalesce(F.concat(F.lit("page "), F.col("page_token")), first))
    order = W.partitionBy("key").orderBy(F.col("n_studies").isNull(), "source_file", "digest")
    return links.withColumn("copy", F.row_number().over(order))


def page_chains(pages: DataFrame) -> DataFrame:
    """One row per landed page: page_token, next_token, n_studies, chain (key of the page it starts
    with; NULL on a cycle), step (pages before it in its chain), state, next_missing.

    A page that is asked for with the token another page names as next follows it. A token that several pages
    name counts for the one whose key is smallest; of pages with one token the first with studies counts and the
    rest are copies. Pointers to the page before are doubled, each round a join of the (small) links with themselves, so
    a chain of n pages takes log2(n) rounds; what is not led to a start by then lies on or behind a cycle.
    """
    links = materialize(page_links(pages), "page-links")
    nodes = links.where("copy = 1").select("key", "page_token", "next_token", "n_studies")
    lead = nodes.where("next_token IS NOT NULL").groupBy(F.col("next_token").alias("page_token"))
    lead = lead.agg(F.min_by(F.struct("key", "n_studies"), "key").alias("before"))
    open_end = F.col("before").isNull()
    state = nodes.join(lead, "page_token", "left").select(
        "key",
        F.when(~open_end, F.col("before.key")).alias("up"),
        F.when(open_end, F.col("key")).alias("chain"),
        F.when(open_end, 0).otherwise(1).cast("long").alias("step"),
        F.coalesce(F.col("before.n_studies") == 0, F.lit(False)).alias("after_empty"),
    )
    state = materialize(state, "page-pointers")
    rounds = max(1, state.count()).bit_length() + 1
    while rounds and state.where("up IS NOT NULL").head(1):
        ahead = state.select(
            F.col("key").alias("up"), F.col("up").alias("up2"), F.col("chain").alias("chain2"), F.col("step").alias("step2"), F.col("after_empty").alias("empty2")
        )
        doubled = state.join(ahead, "up", "left").select(
            "key",
            F.col("up2").alias("up"),
            F.coalesce("chain", "chain2").alias("chain"),
            (F.col("step") + F.coalesce("step2", F.lit(0))).alias("step"),
            (F.col("after_empty") | F.coalesce("empty2", F.lit(False))).alias("after_empty"),
        )
        state = materialize(doubled, "page-pointers")
        rounds -= 1
    landed = nodes.where("page_token IS NOT NULL").select(F.col("page_token").alias("next_token"), F.lit(True).alias("next_landed"))
    rows = links.join(state, "key").join(landed, "next_token", "left")
    copy, cycle, gap = F.col("copy") > 1, F.col("chain").isNull(), F.col("chain").startswith("page ")
    kind = F.when(copy, COPY).when(cycle, CYCLE).when(gap, AFTER_GAP).when(F.col("after_empty"), AFTER_EMPTY)
    kind = kind.when(F.col("n_studies").isNull(), BROKEN).when(F.col("n_studies") == 0, EMPTY).otherwise(READ)
    return rows.select(
        "page_token",
        "next_token",
        "n_studies",
        "chain",
        F.when(~cycle, F.col("step")).alias("step"),
        kind.alias("state"),
        (F.col("next_token").isNotNull() & F.col("next_landed").isNull()).alias("next_missing"),
    )


def chain_summary(chains: DataFrame) -> DataFrame:
    """Pages and studies by state, and the pages whose next page did not land: one row per state found."""
    return chains.groupBy("state").agg(
        F.count(F.lit(1)).alias("pages"),
        F.coalesce(F.sum("n_studies"), F.lit(0)).alias("studies"),
        F.count_if("next_missing").alias("next_missing"),
    )
