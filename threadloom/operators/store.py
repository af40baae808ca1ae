"""Reads of a thread and log store: filters, pages, folds, names, search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import text as T

LEVELS = ("TRACE", "DEBUG", "INFO", "WARN", "ERROR")


def keyset_page(rows: DataFrame, keys: list[str], after: tuple | None, size: int, descending: bool = True) -> DataFrame:
    """The next page after the key of the last row seen, one row more to tell whether there is another."""
    order = [F.col(k).desc() if descending else F.col(k).asc() for k in keys]
    if after is not None:
        alternatives = []
        for i, k in enumerate(keys):
            here = F.col(k) < F.lit(after[i]) if descending else F.col(k) > F.lit(after[i])
            alternatives.append(reduce(lambda a, b: a & b, [*(F.col(keys[j]) == F.lit(after[j]) for j in range(i)), here]))
        rows = rows.where(reduce(lambda a, b: a | b, alternatives))
    return rows.orderBy(*order).limit(size + 1)


def log_filter(level: Column, least: str | None = None, since: Column | None = None, until: Column | None = None, ts: Column | None = None, any_like: list[Column] | None = None,
               thread: Column | None = None, threads: list[str] | None = None, threadless: bool = False, id_: Column | None = None, after_id: int | None = None) -> Column:
    """One condition out of those given; levels are those at or above ``least``.

    ``threads`` keeps their rows, ``threadless`` those of none, both together
    either; ``after_id`` keeps what came after that row.
    """
    out = F.lit(True)
    if thread is not None and (threads is not None or threadless):
        out &= F.coalesce(thread.isin(*(threads or [])), F.lit(False)) | (thread.isNull() if threadless else F.lit(False))
    if id_ is not None and after_id is not None:
        out &= id_ > after_id
    if least:
        out &= F.upper(level).isin(*LEVELS[LEVELS.index(least) :])
    if ts is not None and since is not None:
        out &= ts >= since
    if ts is not None and until is not None:
        out &= ts <= until
    if any_like:
        out &= reduce(lambda a, b: a | b, any_like)
    return out


def thread_times(threads: DataFrame) -> DataFrame:
    """Epoch seconds and milliseconds told apart and put in milliseconds."""
    ms = lambda c: F.when(F.col(c) < 1_577_836_800_000, F.col(c) * 1000).otherwise(F.col(c))
    return threads.withColumns({c: ms(c) for c in ("created_at", "updated_at", "archived_at")})


def listing(threads: DataFrame, archived: bool = False, sources: tuple[str, ...] = (), providers: tuple[str, ...] = (), term: str | None = None) -> DataFrame:
    """Threads of an archive state, and of sources, providers and a word in the title where these are given."""
    out = threads.where(F.col("archived") == int(archived))
    out = out.where(F.col("source").isin(*sources)) if sources else out
    out = out.where(F.col("model_provider").isin(*providers)) if providers else out
    return out if term is None else out.where(F.contains(F.lower(F.coalesce("title", F.lit(""))), F.lit(term.lower())))


def item_page(items: DataFrame, status: str | None, after: int | None, size: int) -> DataFrame:
    """Items of a job by ``row_index``, of one status if given, after a place; one row more tells of the next page."""
    rows = items if status is None else items.where(F.col("status") == status)
    rows = rows if after is None else rows.where(F.col("row_index") > after)
    return rows.orderBy("row_index").limit(size + 1)


def metadata_fold(rows: DataFrame) -> DataFrame:
    """(thread_id, model, first_user_message, title, tokens_used) folded from the ordered rows of a rollout.

    ``rows`` has thread_id, at, kind, meta_id, model, text, tokens. Session
    rows that name another thread count for nothing; the latest model of a turn
    counts, the first text of a user that is not blank, which also gives the
    title once, and the last token total, not below zero.
    """
    own = rows.where((F.col("kind") != "session_meta") | F.coalesce(F.col("meta_id") == F.col("thread_id"), F.lit(False)))
    kind = F.col("kind")
    model = F.when(kind.isin("turn_context", "session_meta") & F.col("model").isNotNull(), F.struct("at", "model"))
    said = F.when((kind == "user_message") & (F.trim("text") != ""), F.struct("at", "text"))
    tokens = F.when((kind == "token_count") & F.col("tokens").isNotNull(), F.struct("at", "tokens"))
    g = own.groupBy("thread_id").agg(F.max(model)["model"].alias("model"), F.min(said)["text"].alias("first_user_message"), F.greatest(F.lit(0), F.coalesce(F.max(tokens)["tokens"], F.lit(0))).alias("tokens_used"))
    return g.withColumn("title", F.substring("first_user_message", 1, 60)).select("thread_id", "model", "first_user_message", "title", "tokens_used")


def names(threads: DataFrame, index: DataFrame) -> DataFrame:
    """The title of each thread, else the newest entry of an append-only name index; blanks do not count."""
    newest = index.where(F.trim("name") != "").groupBy(F.col("id").alias("k")).agg(F.max_by("name", "pos").alias("indexed"))
    j = threads.join(newest, F.col("id") == F.col("k"), "left")
    return j.select("id", F.coalesce(F.when(F.trim(F.coalesce("title", F.lit(""))) != "", F.col("title")), F.col("indexed")).alias("name"))


def search(items: DataFrame, listing: DataFrame, term: str, page: int) -> DataFrame:
    """Threads whose items hold ``term``, newest first, with a snippet of the first hit; one more than a page tells of the next."""
    hit = T.snippet(F.col("item_json"), term)
    hits = items.select("thread_id", "rollout_ordinal", hit.alias("snippet")).where("snippet is not null")
    first = hits.groupBy("thread_id").agg(F.min_by("snippet", F.struct("rollout_ordinal", "snippet")).alias("snippet"), F.count("*").alias("n_hits"))
    return listing.join(first, F.col("id") == F.col("thread_id")).orderBy(F.col("updated_at").desc(), F.col("id").desc()).limit(page + 1)


def new_files(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    """Candidates that a ledger knows neither by (path, time) nor by content."""
    unseen = candidates.join(ledger.select("path", "mtime"), ["path", "mtime"], "left_anti")
    return unseen.join(ledger.select("digest").distinct(), "digest", "left_anti")


def archived_as_found(found: DataFrame, now: Column) -> DataFrame:
    """``found`` with archived and archived_at by where its file lies: below an archive folder it is archived, else not.

    What was archived keeps its time.
    """
    there = F.col("rollout_path").rlike(r"(^|/)archived[^/]*/")
    return found.withColumns({"archived_at": F.when(there, F.coalesce("archived_at", now)), "archived": there.cast("int")})


def reconcile(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Upsert of thread rows: git facts and an explicit title that exist are kept."""
    e = existing.select(*(F.col(c).alias(f"e_{c}") for c in existing.columns))
    j = found.join(e, F.col("id") == F.col("e_id"), "full")
    keep_old = {"git_sha", "git_branch", "git_origin_url", "title"}
    pick = lambda c: F.coalesce(F.when(F.col(f"e_{c}") != "", F.col(f"e_{c}")), F.col(c)) if c in keep_old else F.coalesce(F.col(c), F.col(f"e_{c}"))
    return j.select(*(pick(c).alias(c) for c in existing.columns))


def progress(items: DataFrame, by: list[str], status: str, states: tuple[str, ...]) -> DataFrame:
    """Total and the count of each state; states without rows count nothing."""
    return items.groupBy(*by).agg(F.count("*").alias("total"), *(F.count_if(F.col(status) == s).alias(f"n_{s.lower()}") for s in states))


def metrics_rollup(rows: DataFrame, by: list[str], value: str, order: str) -> DataFrame:
    """Additive counts and sums, and the last positive value."""
    positive = F.when(F.col(value) > 0, F.struct(order, value))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.sum(value), 4).alias("total"), F.max(positive)[value].alias("last_positive"))


def trimmed_history(rows: DataFrame, keys: list[str], order: str, n_bytes: str, most: int) -> DataFrame:
    """The newest entries within 80 per cent of ``most`` bytes once ``most`` is passed; the newest always stays."""
    from threadloom.operators.ordered import COUNT, SUM, running

    back = running(rows.withColumn("__back", -F.col(order)), keys, ["__back"], {"__bytes": (SUM, F.col(n_bytes)), "__n": (COUNT, F.lit(1))})
    total = rows.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.sum(n_bytes).alias("__total"))
    on = [F.col(k) == F.col(f"__{k}") for k in keys]
    kept = (F.col("__total") <= most) | (F.col("__bytes") <= F.floor(F.lit(most) * 0.8)) | (F.col("__n") == 1)
    return back.join(total, on).where(kept).select(*rows.columns)
