"""The whole job over captured pages: campaigns, listings, products.

``extract`` turns each page row into small arrays without any shuffle; the
joins and limits after it move only those. A run chooses first and parses then:
each stage parses just the pages that the stage before called for.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.urls import is_campaign_url, is_http, is_listing_url, is_product_url, url_id
from ..operators.cards import (
    campaign_cards, labels_text, listing_plan, page_links, product_cards, subpages,
)
from ..operators.detail import complete_color, detail_columns
from ..operators.tables import first_per_key, frontier, limit_per_key
from ..operators.tree import shred
from ..rules import DEFAULT_PROFILE, SiteProfile
from ..session import cut
from ..sources.commits import LEGACY, Commit, Manifest, Store
from ..sources.tables import CAMPAIGN_COLUMNS, PRODUCT_COLUMNS, conform, crawl_store, run_timestamp


# ---- fixed value: listings without a name are numbered ----
UNNAMED_LISTING = "subpagina_"
# ---- end of fixed values ----


# -- one page kind at a time -------------------------------------------
def extract_links(pages: DataFrame, profile: SiteProfile = DEFAULT_PROFILE) -> DataFrame:
    """Every link of every page."""
    tree = shred(pages.select("page_id", "html"), profile=profile)
    links = tree.select("page_id", F.inline(page_links(profile)))
    return links.select("page_id", "pos", "url", "label", "kinds")


def extract_campaigns(pages: DataFrame, profile: SiteProfile = DEFAULT_PROFILE) -> DataFrame:
    """Campaign cards of home pages."""
    tree = shred(pages.select("page_id", "html"), profile=profile)
    return tree.select("page_id", F.inline(campaign_cards(profile)))


def extract_subpages(pages: DataFrame, profile: SiteProfile = DEFAULT_PROFILE) -> DataFrame:
    """Ordered sub-pages of campaign pages, one row each."""
    tree = shred(pages.select("url", "html"), profile=profile)
    found = tree.select(F.col("url").alias("campaign_url"), subpages("url", profile).alias("s"))
    return found.select("campaign_url", F.posexplode("s").alias("pos", "sub")).select(
        "campaign_url", "pos", "sub.url", "sub.label"
    )


def extract_products(pages: DataFrame, profile: SiteProfile = DEFAULT_PROFILE) -> DataFrame:
    """Product cards of listing pages."""
    tree = shred(pages.select("page_id", "url", "html"), profile=profile)
    return tree.select("page_id", "url", F.inline(product_cards(profile)))


def extract_details(pages: DataFrame, profile: SiteProfile = DEFAULT_PROFILE) -> DataFrame:
    """What each product page gives by itself."""
    tree = shred(pages.select("page_id", "url", "html"), profile=profile)
    wide = tree.select("page_id", "url", *[c.alias(n) for n, c in detail_columns(profile).items()])
    return wide.select("*", "price.*").drop("price")


def product_details(
    details: DataFrame, stubs: DataFrame, profile: SiteProfile = DEFAULT_PROFILE
) -> DataFrame:
    """Stub rows completed with their page (C21): the page's name wins over
    the card's, and the colour may come from that name."""
    known = details.withColumnRenamed("url", "product_url").drop("page_id")
    joined = stubs.join(known, "product_url")
    name = F.coalesce(F.nullif("detail_name", F.lit("")), "product_name", F.lit(""))
    named = joined.withColumn("product_name", name)
    color = complete_color("product_name", "color_before_name", "color_after_name", profile)
    return named.withColumn("color", color).drop(
        "detail_name", "color_before_name", "color_after_name"
    )


# -- the whole job -----------------------------------------------------
@dataclass(frozen=True)
class Extracts:
    """Small tables taken from the pages, one row per URL."""

    homes: DataFrame
    campaigns: DataFrame
    listings: DataFrame
    products: DataFrame


PARTS = ("homes", "campaigns", "listings", "products")
DETAIL_TYPES = {
    "detail_name": "string", "description": "string",
    "price": "struct<original_price:string,discount_price:string,discount_percentage:string>",
    "color_before_name": "string", "color_after_name": "string", "image_url": "string", "sizes_status": "string",
}
PART_TYPES = {
    "cards": "array<struct<pos:int,name:string,url:string,end_date:string>>",
    "subpages": "array<struct<url:string,label:string>>",
    "stubs": "array<struct<pos:int,product_url:string,product_name:string>>",
}


def extract(
    pages: DataFrame, home: Column | list[str], profile: SiteProfile = DEFAULT_PROFILE,
    parts: Sequence[str] = PARTS,
) -> DataFrame:
    """One pass over the pages: per page, only the parts its URL calls for.
    ``home`` names the home pages, by URL or by a condition. Pages that none of
    ``parts`` asks for are neither parsed nor looked into; the columns are the
    same whatever the parts.

    No shuffle. The result has no HTML and is what later steps join.
    """
    url = F.col("url")
    asked = lambda part, condition: condition if part in parts else F.lit(False)
    home = asked("homes", url.isin(*home) if isinstance(home, list) else home)
    campaign = asked("campaigns", is_campaign_url(url, profile))
    listing = asked("listings", is_campaign_url(url, profile) | is_listing_url(url, profile))
    product = asked("products", is_product_url(url, profile))
    wanted = pages.select("page_id", "url", "html").filter(home | campaign | listing | product)
    tree = shred(wanted, profile=profile)
    # A part that is not asked for is a typed null, so nothing of it is planned.
    found: dict[str, Column] = {}
    if "homes" in parts:
        found["cards"] = F.when(home, campaign_cards(profile))
    if "campaigns" in parts:
        found["subpages"] = F.when(campaign, subpages("url", profile))
    if "listings" in parts:
        found["stubs"] = F.when(listing, product_cards(profile))
    if "products" in parts:
        found |= {n: F.when(product, c) for n, c in detail_columns(profile).items()}
    types = PART_TYPES | DETAIL_TYPES
    column = {n: found.get(n, F.lit(None).cast(t)).alias(n) for n, t in types.items()}
    return tree.select(
        "page_id", "url", "error", *[column[n] for n in PART_TYPES],
        home.alias("is_home"), campaign.alias("is_campaign"),
        listing.alias("is_listing"), product.alias("is_product"),
        *[column[n] for n in DETAIL_TYPES],
    )


def split(extracts: DataFrame) -> Extracts:
    """Per kind, the first capture of each URL that could be read. Copies of a
    page fall away inside each task before anything is shuffled."""
    extracts = extracts.filter("error is null")
    first = lambda df: first_per_key(df, ["url"], ["page_id"])
    products = extracts.filter("is_product").select("page_id", "url", *DETAIL_TYPES)
    return Extracts(
        homes=extracts.filter("is_home").select("page_id", "url", "cards"),
        campaigns=first(extracts.filter("is_campaign").select("page_id", "url", "subpages")),
        listings=first(extracts.filter("is_listing").select("page_id", "url", "stubs")),
        products=first(products).select("*", "price.*").drop("price"),
    )


def found_campaigns(homes: DataFrame) -> DataFrame:
    """The first card of each campaign on the home pages."""
    cards = homes.select("page_id", F.inline("cards")).withColumnRenamed("url", "campaign_url")
    return first_per_key(cards, ["campaign_url"], ["page_id", "pos"])


def campaign_frontier(
    homes: DataFrame, visited: DataFrame | None, profile: SiteProfile = DEFAULT_PROFILE,
    allow_duplicates: bool = False, entry: int = 1,
) -> DataFrame:
    """New campaigns in order of discovery, up to the limit (C24). ``entry`` is
    the number of the run that finds them."""
    chosen = frontier(
        found_campaigns(homes), visited, "campaign_url", ["page_id", "pos"], profile.max_campaigns,
        is_http("campaign_url"), allow_duplicates,
    )
    return chosen.withColumn("entry", F.lit(entry).cast("long"))


STEP_COLUMNS = ("campaign_url", "name", "end_date", "page_pos", "url", "subcategory", "entry")
STUB_COLUMNS = (
    "campaign_url", "page_pos", "pos", "product_url", "product_name", "subcategory", "campaign_name",
    "campaign_sector", "campaign_end_date", "entry",
)


def listing_steps(
    campaigns: DataFrame, pages: Extracts, profile: SiteProfile = DEFAULT_PROFILE
) -> tuple[DataFrame, DataFrame]:
    """``(plans, steps)``: the campaigns whose page is there, and their listings.

    A listing is joined by its own URL, whatever its place in the plan."""
    own = campaigns.join(pages.campaigns.select(F.col("url").alias("campaign_url"), "subpages"), "campaign_url")
    plans = own.withColumn("plan", listing_plan("subpages", "campaign_url", profile.max_subpages))
    steps = plans.select(
        "campaign_url", "name", "end_date", "entry", F.posexplode("plan").alias("page_pos", "step")
    ).select(
        "campaign_url", "name", "end_date", "page_pos", F.col("step.url").alias("url"),
        F.coalesce(
            F.nullif("step.label", F.lit("")),
            F.concat(F.lit(UNNAMED_LISTING), (F.col("page_pos") + 1).cast("string")),
        ).alias("subcategory"),
        "entry",
    )
    return plans, steps


def product_stubs(hits: DataFrame) -> DataFrame:
    """Distinct products per campaign: the earliest listing's row."""
    flat = hits.select(
        "campaign_url", "name", "end_date", "page_pos", "subcategory", "entry", F.inline("stubs")
    )
    first = first_per_key(flat, ["campaign_url", "product_url"], ["page_pos", "pos"])
    return first.select(
        "campaign_url", "page_pos", "pos", "product_url", "product_name", "subcategory",
        F.col("name").alias("campaign_name"),
        F.lit("").alias("campaign_sector"),
        F.col("end_date").alias("campaign_end_date"),
        "entry",
    )


def campaign_summary(
    plans: DataFrame, hits: DataFrame, stubs: DataFrame, run_ts: str,
    profile: SiteProfile = DEFAULT_PROFILE,
) -> DataFrame:
    """Campaign rows in sink order (C22). Pages and products are counted
    apart; only one number per campaign meets the campaign row."""
    listed = hits.groupBy("campaign_url").agg(F.sum(F.size("stubs")).alias("total_products_count"))
    unique = stubs.groupBy("campaign_url").agg(F.count("*").alias("unique_products_count"))
    rows = plans.join(listed, "campaign_url", "left").join(unique, "campaign_url", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return rows.select(
        url_id("campaign_url", profile).alias("campaign_id"),
        "campaign_url",
        zero("total_products_count").alias("total_products_count"),
        zero("unique_products_count").alias("unique_products_count"),
        F.trim("name").alias("brand_name"),
        labels_text("subpages").alias("subcategories"),
        F.col("end_date").alias("end_date_text"),
        run_timestamp(run_ts).alias("extraction_timestamp"),
        "entry",
    )


def corrected_campaigns(stored: DataFrame, late: DataFrame, counted: DataFrame) -> DataFrame:
    """Stored campaigns with the counts that ``late`` listings add.

    ``late`` are hits of campaigns that an earlier run stored, ``counted`` the
    distinct products that it counted, per campaign and entry. The other
    columns stay, the timestamp too: the row is still that of its first run."""
    key = ["campaign_url", "entry"]
    listed = late.groupBy(*key).agg(F.sum(F.size("stubs")).alias("__listed"))
    fresh = listed_products(late).join(counted, [*key, "product_url"], "left_anti")
    unique = fresh.groupBy(*key).agg(F.count("*").alias("__unique"))
    rows = stored.join(listed, key).join(unique, key, "left")
    more = {"total_products_count": "__listed", "unique_products_count": "__unique"}
    sums = {c: F.col(c) + F.coalesce(F.col(n), F.lit(0)) for c, n in more.items()}
    return rows.withColumns(sums).select(*CAMPAIGN_COLUMNS, "entry")


def listed_products(hits: DataFrame) -> DataFrame:
    """Distinct products per campaign and entry."""
    return hits.select("campaign_url", "entry", F.explode("stubs.product_url").alias("product_url")).distinct()


def chosen_stubs(stubs: DataFrame, profile: SiteProfile = DEFAULT_PROFILE) -> DataFrame:
    """The products to complete: the limit per campaign comes before the join
    with the product pages."""
    chosen = limit_per_key(stubs, ["campaign_url"], ["page_pos", "pos"], profile.max_products)
    return chosen.filter(is_http("product_url"))


def product_rows(
    chosen: DataFrame, details: DataFrame, run_ts: str, profile: SiteProfile = DEFAULT_PROFILE
) -> DataFrame:
    """Product rows in sink order."""
    full = product_details(details, chosen, profile)
    rows = full.select(
        "*",
        url_id("product_url", profile).alias("product_id"),
        url_id("campaign_url", profile).alias("campaign_id"),
        run_timestamp(run_ts).alias("extraction_timestamp"),
    )
    return conform(rows, PRODUCT_COLUMNS)


@dataclass(frozen=True)
class Pending:
    """Open work: listings of known campaigns, and products, without a page;
    and the products that campaigns with open listings have counted so far."""

    listings: DataFrame
    products: DataFrame
    counted: DataFrame


def crawl(
    extracts: DataFrame, run_ts: str, profile: SiteProfile = DEFAULT_PROFILE,
    visited: DataFrame | None = None, allow_duplicates: bool = False, pending: Pending | None = None,
    stored: DataFrame | None = None, known: DataFrame | None = None, entry: int = 1,
    hold: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> tuple[DataFrame, DataFrame, Pending]:
    """``(campaigns, products, pending)`` of a run. ``pending`` of an earlier run
    is taken up first; limits hold within a run. ``campaigns`` are the new ones
    and, of ``stored``, those whose counts grow by listings that were open.
    Products in ``known`` are stored and left alone. ``hold`` is given what several
    results use, to write it once (``cut``) where all of them are wanted."""
    pages = split(extracts)
    key = ["campaign_url", "entry"]
    new = campaign_frontier(pages.homes, visited, profile, allow_duplicates, entry)
    plans, steps = listing_steps(new, pages, profile)
    plans = hold(plans, "plans")
    every = hold(steps if pending is None else steps.unionByName(pending.listings), "steps")
    hits = hold(every.join(pages.listings.select("url", "stubs"), "url"), "hits")
    stubs = product_stubs(hits)
    chosen = chosen_stubs(stubs, profile)
    if pending is not None:
        both = chosen.unionByName(pending.products)
        chosen = first_per_key(both, ["campaign_url", "product_url"], ["page_pos", "pos"])
    if known is not None:
        chosen = chosen.join(known, ["campaign_url", "product_url"], "left_anti")
    chosen = hold(chosen, "chosen")
    fresh = hits.join(plans.select(*key), key, "left_semi") if pending else hits
    own = product_stubs(fresh) if pending else stubs
    campaigns = campaign_summary(plans, fresh, own, run_ts, profile)
    open_listings = hold(every.join(pages.listings.select("url"), "url", "left_anti").select(*STEP_COLUMNS), "open")
    counted = listed_products(hits)
    if pending is not None:
        if stored is not None:
            late = hits.join(plans.select(*key), key, "left_anti")
            campaigns = campaigns.unionByName(corrected_campaigns(stored, late, pending.counted))
        counted = counted.unionByName(pending.counted).distinct()
    seen_products = pages.products.select(F.col("url").alias("product_url"))
    left = Pending(
        open_listings,
        chosen.join(seen_products, "product_url", "left_anti").select(*STUB_COLUMNS),
        counted.join(open_listings.select(*key), key, "left_semi"),
    )
    return campaigns.select(*CAMPAIGN_COLUMNS, "entry"), product_rows(chosen, pages.products, run_ts, profile), left


def extract_chosen(
    pages: DataFrame, home: Column | list[str], profile: SiteProfile = DEFAULT_PROFILE,
    visited: DataFrame | None = None, allow_duplicates: bool = False, pending: Pending | None = None,
    homes: DataFrame | None = None, choose: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The extracts that a run needs, in four stages: home pages, pages of new
    campaigns, listings in their plans, chosen products. Each stage parses only
    pages whose URL the one before named, and is written to the shared folder.
    ``homes`` is the first stage, if it is known.

    The keys of a stage are one narrow column, written first so that its size is
    known: few of them are broadcast to the scan; of many, Spark's own Bloom
    filter thins the pages before the join. A stage without keys reads nothing.
    ``choose`` gives the pages of a table of keys; that of a ``PageStore`` moves no HTML.
    """
    chosen = choose or (lambda keys: pages.join(keys, "url", "left_semi"))
    if homes is None:
        homes = cut(extract(pages, home, profile, PARTS[:1]), "homes")

    def stage(part: Sequence[str], keys: DataFrame) -> DataFrame:
        keys = cut(keys.toDF("url").distinct(), "keys")
        if keys.isEmpty():
            return homes.limit(0)
        return cut(extract(chosen(keys), home, profile, part), part[0])

    new = campaign_frontier(split(homes).homes, visited, profile, allow_duplicates)
    new = cut(new, "frontier")
    campaigns = stage(PARTS[1:3], new.select("campaign_url"))
    _, steps = listing_steps(new, split(campaigns), profile)
    if pending is not None:
        steps = steps.unionByName(pending.listings)
    listings = stage(PARTS[2:3], steps.select("url").join(campaigns.select("url"), "url", "left_anti"))
    parsed = campaigns.unionByName(listings)
    hits = steps.join(split(parsed).listings.select("url", "stubs"), "url")
    wanted = chosen_stubs(product_stubs(hits), profile).select("product_url")
    if pending is not None:
        wanted = wanted.unionByName(pending.products.select("product_url"))
    return homes.unionByName(parsed).unionByName(stage(PARTS[3:], wanted))


def crawl_tables(
    extracts: DataFrame, run_ts: str, profile: SiteProfile = DEFAULT_PROFILE,
    visited: DataFrame | None = None, allow_duplicates: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(campaigns, products)`` of a run, as DataFrames."""
    campaigns, products, _ = crawl(extracts, run_ts, profile, visited, allow_duplicates)
    return campaigns.select(*CAMPAIGN_COLUMNS), products


NO_CAMPAIGN = "no campaign on the home pages"


def _open_work(store: Store, base: Manifest) -> Pending | None:
    if not (base.tables["open_listings"] or base.tables["open_products"]):
        return None
    listings, products = (store.read(n, base).fillna(-1, ["entry"]) for n in ("open_listings", "open_products"))
    counted = store.read("open_counted", base)
    if base.version == 0:
        # Tables of plain files do not say what was counted: products that are stored or open were.
        both = store.read("products", base).select("campaign_url", "product_url").union(products.select("campaign_url", "product_url"))
        counted = both.withColumn("entry", F.lit(-1).cast("long")).select("campaign_url", "entry", "product_url").distinct()
    return Pending(listings, products, counted)


def _unkeyed(base: Manifest, rows: str, keys: str) -> bool:
    """Whether stored rows are not in their key table, as they are plain files."""
    return LEGACY in base.tables[rows] and not base.tables[keys]


def _stored_keys(store: Store, base: Manifest, rows: str, keys: str, candidates: DataFrame) -> DataFrame:
    """Keys of stored rows that share the candidates' values."""
    if _unkeyed(base, rows, keys):
        named = store.read(rows, base).select(*store.read(keys, base).columns)
        return named.join(candidates, candidates.columns, "left_semi").distinct()
    return store.matching(keys, candidates, base)


def _reject(commit: Commit, pages: DataFrame, bad: DataFrame) -> None:
    """Keep unreadable pages, ``bad(page_id, url, error)``, with their HTML; each once."""
    known = commit.store.read("rejects", commit.base).select("page_id", "url", "error")
    same = lambda a, b, names: [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in names]
    new = cut(bad.distinct().alias("b").join(known.alias("k"), same("b", "k", ("page_id", "url", "error")), "left_anti"), "rejects")
    if not new.isEmpty():
        rows = pages.select("page_id", "url", "html").alias("p").join(new.alias("b"), same("p", "b", ("page_id", "url")))
        commit.append("rejects", rows.select("p.*", "b.error").dropDuplicates(["page_id", "url", "error"]))


def store_run(
    store: Store, pages: DataFrame, extracts: DataFrame, run_ts: str, profile: SiteProfile = DEFAULT_PROFILE,
    visited: DataFrame | None = None, allow_duplicates: bool = False, pending: Pending | None = None,
) -> dict[str, int]:
    """Write all that a run found as one commit; returns the rows per table.

    A run that stops anywhere before the end leaves the tables as they were. Raises
    ``Conflict`` if another run committed since this one began."""
    commit = store.begin()
    base, key = commit.base, ["campaign_url", "product_url"]
    stored = store.read("campaigns", base, pending.listings.select("campaign_url").distinct()) if pending else None
    known = None
    if not allow_duplicates:
        listed = split(extracts).listings.select(F.explode("stubs.product_url").alias("product_url"))
        if pending:
            listed = listed.unionByName(pending.products.select("product_url"))
        known = _stored_keys(store, base, "products", "product_keys", cut(listed.distinct(), "listed"))
    campaigns, products, left = crawl(
        extracts, run_ts, profile, visited, allow_duplicates, pending, stored, known, commit.version, cut
    )
    commit.append("products", products)
    new_keys = commit.staged("products").select(*key)
    if _unkeyed(base, "products", "product_keys"):
        new_keys = new_keys.unionByName(store.read("products", base).select(*key)).distinct()
    commit.append("product_keys", new_keys)
    commit.replace("open_listings", left.listings)
    commit.replace("open_products", left.products)
    commit.replace("open_counted", left.counted)
    commit.append("campaigns", campaigns)
    added = commit.staged("campaigns").filter(F.col("entry") == commit.version).select("campaign_url")
    if _unkeyed(base, "campaigns", "campaign_keys"):
        added = added.unionByName(store.read("campaigns", base).select("campaign_url")).distinct()
    commit.append("campaign_keys", added)
    _reject(commit, pages, extracts.filter("error is not null").select("page_id", "url", "error"))
    commit.publish()
    return commit.written


def run(
    pages: DataFrame, home: Column | list[str], campaigns_path: str, products_path: str, run_ts: str,
    profile: SiteProfile = DEFAULT_PROFILE, fmt: str = "csv", allow_duplicates: bool = False,
    rejects_path: str | None = None, pending_path: str | None = None,
    choose: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, int]:
    """Read pages, write both tables, the rejects and what is left open; returns counters.

    Only pages that the run needs are parsed (``extract_chosen``, which ``choose`` is for), and once.
    Everything is written as one commit (``sources.commits``): a run that stops
    before its end leaves all tables as they were, and a repeated one adds nothing
    twice. ``stored_rows`` reads the tables. Listings and products without a
    readable page go to ``pending_path`` (by default beside the campaigns), and the
    next run takes them up; a campaign whose open listings come in gets its counts
    corrected. Unreadable pages are kept in ``rejects_path`` with their HTML. Home
    pages without any campaign are kept there too, and are an error.

    The counters: campaigns ``found`` on the home pages, ``skipped`` as stored and
    ``new``; ``campaigns`` and ``products`` written (``corrected`` campaigns apart),
    ``rejected`` pages, ``open_listings`` and ``open_products``. They are observed
    while the tables are written; no job is run for them.
    """
    spark = pages.sparkSession
    store = crawl_store(spark, campaigns_path, products_path, fmt, rejects_path, pending_path)
    base = store.manifest()
    pending = _open_work(store, base)
    homes = cut(extract(pages, home, profile, PARTS[:1]), "homes")
    found, skipped = Observation(), Observation()
    rows = F.count(F.lit(1)).alias("rows")
    cards = cut(found_campaigns(split(homes).homes).select("campaign_url").observe(found, rows), "found")
    if cards.isEmpty():
        commit = store.begin()
        bad = homes.filter("is_home").select("page_id", "url", F.coalesce("error", F.lit(NO_CAMPAIGN)).alias("error"))
        _reject(commit, pages, bad)
        commit.publish()
        raise ValueError(NO_CAMPAIGN)
    visited = cut(_stored_keys(store, base, "campaigns", "campaign_keys", cards).observe(skipped, rows), "visited")
    extracts = extract_chosen(pages, home, profile, None if allow_duplicates else visited, allow_duplicates, pending, homes, choose)
    written = store_run(store, pages, extracts, run_ts, profile, None if allow_duplicates else visited, allow_duplicates, pending)
    n_found, n_stored = found.get["rows"], 0 if allow_duplicates else skipped.get["rows"]
    return {
        "found": n_found, "skipped": n_stored, "new": n_found - n_stored, "campaigns": written["campaign_keys"],
        "corrected": written["campaigns"] - written["campaign_keys"], "products": written["products"],
        "rejected": written.get("rejects", 0), "open_listings": written["open_listings"], "open_products": written["open_products"],
    }
