"""The queries of :mod:`queries` as plain SQL over the same tables.

Rules are written out again here, in another form, to check the operators against.
"""

from __future__ import annotations

from threadlytics.functions.text import WHITESPACE
from threadlytics.sources import adapters

SPACE = f"'{WHITESPACE}'"
ISO = "'%Y-%m-%dT%H:%M:%SZ'"
# Anything but a letter, digit or underscore.
OTHER = r"[^\p{L}\p{N}_]"


def trim(x: str) -> str:
    return f"trim({x}, {SPACE})"


def iso(x: str) -> str:
    return f"strftime({x}, {ISO})"


def adapter(text: str) -> str:
    return text.format(conversations="conversations", events="events")


def lexicon(x: str) -> str:
    """Hype of a text: each term once, in a fixed order of addition."""
    low = f"lower({x})"
    terms = [
        ("🚀", "0.3"), ("moon", "0.3"), ("diamond hands", "0.3"), ("lfg", "0.3"), ("yolo", "0.3"),
        ("💎", "0.3"), ("🙌", "0.3"), ("let''s go", "0.2"), ("i''m in", "0.2"), ("buying", "0.2"),
        ("hold", "0.2"), ("bullish", "0.2"), ("risky", "-0.2"), ("careful", "-0.2"),
        ("not sure", "-0.2"), ("bear", "-0.2"), ("sell", "-0.2"),
    ]
    parts = [
        f"case when contains({low}, '{t}') then cast({w} as double) else cast(0 as double) end"
        for t, w in terms
    ]
    parts.append(
        f"case when contains({x}, '!!!') then cast(0.2 as double) "
        f"when contains({x}, '!') then cast(0.1 as double) else cast(0 as double) end"
    )
    parts.append(
        f"case when upper({x}) = {x} and {low} <> {x} and length({x}) > 3 "
        "then cast(0.2 as double) else cast(0 as double) end"
    )
    total = " + ".join(parts)
    return f"greatest(cast(0 as double), least(cast(1 as double), {total}))"


def escaped(x: str) -> str:
    return f"replace({x}, '.', '\\.')"


def span_parts(x: str, t: str) -> tuple[str, str]:
    """Start and end of a ticker ``t`` (letters and dots) in ``x``."""
    e = escaped(t)
    tail = f"{e} || '(?:$|{OTHER})'"
    tagged = f"'(?is)^(.*?)\\$' || {tail}"
    word = f"'(?is)^((?:.*?{OTHER})??)' || {tail}"
    loud = f"upper(replace({x}, 'ß', 'SS'))"
    loose = f"strpos({loud}, upper({t}))"
    start = (
        f"case when length({t}) = 0 or {loose} = 0 then -1 "
        f"when regexp_matches({x}, {tagged}) then length(regexp_extract({x}, {tagged}, 1)) "
        f"when regexp_matches({x}, {word}) then length(regexp_extract({x}, {word}, 1)) "
        f"else {loose} - 1 end"
    )
    end = (
        f"case when length({t}) = 0 or {loose} = 0 then -1 "
        f"when regexp_matches({x}, {tagged}) then length(regexp_extract({x}, {tagged}, 1)) + length({t}) + 1 "
        f"when regexp_matches({x}, {word}) then length(regexp_extract({x}, {word}, 1)) + length({t}) "
        f"else {loose} - 1 + length({t}) end"
    )
    return f"cast({start} as integer)", f"cast({end} as integer)"


def confidence(t: str, name: str, seen: str) -> str:
    return (
        "greatest(cast(0.3 as double), least(cast(1 as double), cast(0.8 as double)"
        f" + case when coalesce({trim(name)}, '') <> '' then cast(0.1 as double) else cast(0 as double) end"
        f" + case when length({t}) <= 2 then cast(-0.1 as double) when length({t}) >= 4"
        " then cast(0.05 as double) else cast(0 as double) end"
        f" - case when {seen} then cast(0 as double) else cast(0.2 as double) end))"
    )


BEST = """row_number() over (partition by kind, content_reddit_id, ticker
  order by confidence desc, pos) = 1"""

PARTS = {
    "raw_posts": adapter(adapters.RAW_POSTS_SQL),
    "raw_comments": adapter(adapters.RAW_COMMENTS_SQL),
    "posts": f"""select id as reddit_id, {trim('title')} as title, {trim('selftext')} as text, url,
      nullif(author, '') as author, coalesce(score, 0) as score, coalesce(num_comments, 0) as num_comments,
      coalesce(total_awards_received, 0) as total_awards,
      coalesce(upvote_ratio, cast(0 as double)) as upvote_ratio,
      make_timestamp(coalesce(created_utc, 0) * 1000000) as created_utc,
      'https://reddit.com' || nullif(permalink, '') as permalink,
      coalesce(nullif(subreddit, ''), 'wallstreetbets') as subreddit, coalesce(link_flair_text, '') as flair,
      make_timestamp(processed_epoch * 1000000) as processed_at
      from raw_posts""",
    "all_comments": f"""select id as reddit_id, post_id as post_reddit_id,
      case when contains(parent_id, '_') then substr(parent_id, strpos(parent_id, '_') + 1) end as parent_reddit_id,
      case left(parent_id, 3) when 't3_' then 'post' when 't1_' then 'comment' end as parent_kind,
      nullif(author, '') as author, coalesce({trim('body')}, '') as body,
      make_timestamp(nullif(created_utc, 0) * 1000000) as created_utc, coalesce(score, 0) as score,
      coalesce(total_awards_received, 0) as total_awards,
      array_to_string(coalesce(all_awardings, awardings, []), ',') as awards,
      make_timestamp(processed_epoch * 1000000) as processed_at, body as raw_body
      from raw_comments""",
    "comments": "select * from all_comments where reddit_id is not null and raw_body <> ''",
    "content": r"""select 'post' as kind, reddit_id, reddit_id as post_reddit_id, title || chr(10) || text as text,
      score, num_comments, created_utc, processed_at from posts
      union all select 'comment', reddit_id, post_reddit_id, body, score, 0, created_utc, processed_at
      from comments""",
    "items": f"""select * from content where {trim('text')} <> ''
      and (kind = 'post' or {trim('text')} not in ('[deleted]', '[removed]'))""",
    "symbols": adapter(adapters.SYMBOLS_SQL),
    # One branch per symbol, so that its patterns are constants.
    "tagged": " union all ".join(
        "select i.*, '{0}' as ticker, '{1}' as company_name, {2} as span_start, {3} as span_end from items i "
        "where regexp_matches(i.text, '(?:^|[^\\p{{L}}\\p{{N}}_$])(?:\\$(?i:{4})|{4})(?:$|{5})')".format(
            symbol, name, *span_parts("i.text", f"'{symbol}'"), symbol.replace(".", "\\."), OTHER
        )
        for symbol, name in [("TSLA", "Tesla Inc."), ("AAPL", "Apple Inc."), ("GME", ""),
                             ("BRK.B", "Berkshire Hathaway Inc."), ("BTC", "Bitcoin")]
    ),
    "direct": f"""select kind, reddit_id as content_reddit_id, post_reddit_id, ticker, span_start, span_end,
      {confidence('ticker', 'company_name', 'span_start >= 0')} as confidence, 'rule' as method,
      {lexicon('text')} as hype_score, company_name,
      case when kind = 'comment' then post_reddit_id end as context_post_id, created_utc, processed_at
      from tagged""",
    "given": """select distinct content_reddit_id as post_reddit_id, ticker, company_name from direct
      where kind = 'post'""",
    "moods": f"""select *, case when length({trim('body')}) < 3 then cast(0 as double)
      else {lexicon('body')} end as hype_score from comments""",
    "inherited": f"""select 'comment' as kind, m.reddit_id as content_reddit_id, m.post_reddit_id, g.ticker,
      cast(-1 as integer) as span_start, cast(-1 as integer) as span_end,
      least(cast(0.75 as double), m.hype_score + cast(0.2 as double)) as confidence,
      'contextual_inheritance' as method, m.hype_score, g.company_name,
      m.post_reddit_id as context_post_id, m.created_utc, m.processed_at
      from moods m join given g using (post_reddit_id)
      where m.hype_score >= 0.3 and m.body not in ('', '[deleted]', '[removed]')
        and m.reddit_id not in (select content_reddit_id from direct where kind = 'comment')""",
    "mentions": "select * from direct union all select * from inherited",
    "handed": """select c.reddit_id, c.parent_reddit_id, m.ticker,
        least(cast(0.5 as double), m.confidence * cast(0.8 as double)) as confidence, 1 as distance
      from comments c join mentions m
        on m.kind = c.parent_kind and m.content_reddit_id = c.parent_reddit_id
      where c.reddit_id not in (select content_reddit_id from mentions where kind = 'comment')
      union all
      select c.reddit_id, c.parent_reddit_id, h.ticker,
        least(cast(0.5 as double), h.confidence * cast(0.8 as double)), h.distance + 1
      from comments c join handed h on c.parent_kind = 'comment' and c.parent_reddit_id = h.reddit_id
      where c.reddit_id not in (select content_reddit_id from mentions where kind = 'comment')""",
    "depths": """select reddit_id, 0 as depth from comments where parent_kind = 'post'
      union all select c.reddit_id, d.depth + 1 from comments c
      join depths d on c.parent_kind = 'comment' and c.parent_reddit_id = d.reddit_id""",
    "event_mentions": adapter(adapters.MENTIONS_SQL),
    "best_events": f"select * from event_mentions qualify {BEST}",
    "responses": adapter(adapters.RESPONSES_SQL),
    "ticker_responses": adapter(adapters.TICKER_RESPONSES_SQL),
    "symbol_files": adapter(adapters.SYMBOL_FILES_SQL),
    "listed": f"""select distinct upper({trim("json_extract_string(e, '$')")}) as symbol from (
      select unnest(cast(case when json_type(value) = 'OBJECT' then json_extract(value, '$.symbols')
        else json(value) end as json[])) as e from symbol_files) t where json_type(e) = 'VARCHAR'""",
    "post_updates": adapter(adapters.POST_UPDATES_SQL),
    "comment_updates": adapter(adapters.COMMENT_UPDATES_SQL),
    "comment_landings": adapter(adapters.COMMENT_LANDINGS_SQL),
    "branching": adapter(adapters.BRANCHING_SQL),
    "landings": adapter(adapters.POST_LANDINGS_SQL),
    "totals_source": f"""select upper(ticker) as ticker, kind, hype_score, created_utc,
      coalesce(company_name, '') as company_name from event_mentions where {trim('ticker')} <> ''""",
}

NEEDS = {
    "posts": ["raw_posts"],
    "all_comments": ["raw_comments"],
    "comments": ["all_comments"],
    "content": ["posts", "comments"],
    "items": ["content"],
    "tagged": ["items"],
    "direct": ["tagged"],
    "given": ["direct"],
    "moods": ["comments"],
    "inherited": ["moods", "given", "direct"],
    "mentions": ["direct", "inherited"],
    "handed": ["comments", "mentions"],
    "depths": ["comments"],
    "best_events": ["event_mentions"],
    "listed": ["symbol_files"],
    "totals_source": ["event_mentions"],
}

ORACLE: dict[str, str] = {}


def define(name: str, needs: str, body: str, **swap: str) -> None:
    """Register ``body`` behind the common table expressions it needs, in order; ``swap`` gives some another text."""
    parts = {**PARTS, **swap}
    ordered: list[str] = []

    def add(part: str) -> None:
        for other in NEEDS.get(part, []):
            add(other)
        if part not in ordered:
            ordered.append(part)

    for part in needs.split():
        add(part)
    tables = ",\n".join(f"{part} as ({parts[part].strip()})" for part in ordered)
    ORACLE[name] = f"with recursive {tables}\n{body}" if ordered else body


def totals(source: str) -> str:
    return f"""select ticker, coalesce(arg_max(company_name, row(created_utc, company_name))
        filter (company_name <> ''), '') as company_name,
      count(*) as total_mentions, count(*) filter (kind = 'post') as total_posts,
      count(*) filter (kind = 'comment') as total_comments,
      round(round(sum(hype_score), 9) / count(*), 2) as avg_hype_score, round(max(hype_score), 2) as max_hype_score,
      max(created_utc) as last_mentioned_at from {source} group by ticker"""


define("read_submissions", "raw_posts", """select id, title, md5(selftext) as text_md5, url, author, score,
  num_comments, total_awards_received, upvote_ratio, created_utc, permalink, subreddit, link_flair_text, true as well_formed from raw_posts""")
define("read_comments", "raw_comments", """select id, post_id, parent_id, author, md5(body) as body_md5, created_utc,
  score, total_awards_received, array_to_string(all_awardings, ',') as all_awardings,
  array_to_string(awardings, ',') as awardings, true as well_formed from raw_comments""")
define("top_posts_of_day", "posts", f"""select reddit_id, title, score, {iso('created_utc')} as created_utc
  from posts where created_utc > timestamp '2024-01-01' and created_utc <= timestamp '2024-01-02'
  order by score desc, reddit_id limit 3""")
define("normalize_posts", "posts", f"""select * exclude (processed_at) replace (md5(text) as text,
    {iso('created_utc')} as created_utc),
  list_reduce(list_transform(string_split(lower(reddit_id), ''),
    lambda c: cast(strpos('0123456789abcdefghijklmnopqrstuvwxyz', c) - 1 as bigint)),
    lambda a, b: a * 36 + b) as reddit_id_int from posts""")
define("normalize_comments", "all_comments", f"""select * exclude (processed_at, raw_body)
  replace (md5(body) as body, {iso('created_utc')} as created_utc) from all_comments""")
define("valid_comments", "comments", "select reddit_id, length(body) as body_length from comments")
define("comment_depth", "depths", """select c.reddit_id, c.parent_reddit_id, d.depth
  from comments c left join depths d using (reddit_id)""")
define("upsert_posts", "posts post_updates", f"""
  , latest as (select * from post_updates
    qualify row_number() over (partition by reddit_id order by landed_at desc) = 1)
  select coalesce(p.reddit_id, u.reddit_id) as reddit_id, coalesce(u.title, p.title) as title,
    md5(p.text) as text_md5, coalesce(u.score, p.score) as score, p.subreddit,
    {iso('p.created_utc')} as created_utc, {iso('p.processed_at')} as processed_at
  from posts p full join latest u on p.reddit_id = u.reddit_id""")
ORACLE["upsert_stored"] = ORACLE["upsert_posts"]
define("upsert_comments", "comments comment_updates", f"""
  , latest as (select * from comment_updates
    qualify row_number() over (partition by reddit_id order by landed_at desc) = 1)
  select coalesce(c.reddit_id, u.reddit_id) as reddit_id, c.post_reddit_id, c.parent_reddit_id, c.author,
    md5(coalesce(u.body, c.body)) as body_md5, coalesce(u.score, c.score) as score, c.total_awards,
    case when u.reddit_id is null then c.awards else array_to_string(coalesce(u.award_names, []), ',') end as awards,
    {iso('c.created_utc')} as created_utc
  from comments c full join latest u on c.reddit_id = u.reddit_id""")
define("merge_stored_tickers", "totals_source", f"""
  , one as (select * from ({totals("(select * from totals_source where created_utc < timestamp '2024-01-20')")}) t),
  two as (select * from ({totals("(select * from totals_source where created_utc >= timestamp '2024-01-20')")}) t),
  sums as (select ticker, round(sum(hype_score), 9) as s from totals_source
    where created_utc >= timestamp '2024-01-20' group by ticker)
  select coalesce(a.ticker, b.ticker) as ticker,
    coalesce(nullif(b.company_name, ''), a.company_name, '') as company_name,
    cast(coalesce(a.total_mentions, 0) + coalesce(b.total_mentions, 0) as integer) as total_mentions,
    cast(coalesce(a.total_posts, 0) + coalesce(b.total_posts, 0) as integer) as total_posts,
    cast(coalesce(a.total_comments, 0) + coalesce(b.total_comments, 0) as integer) as total_comments,
    case when b.ticker is null then a.avg_hype_score else
      round((coalesce(a.avg_hype_score, 0) * coalesce(a.total_mentions, 0) + coalesce(s.s, 0))
        / (coalesce(a.total_mentions, 0) + b.total_mentions), 2) end as avg_hype_score,
    greatest(a.max_hype_score, b.max_hype_score) as max_hype_score,
    {iso('greatest(a.last_mentioned_at, b.last_mentioned_at)')} as last_mentioned_at,
    case when a.ticker is null then '2024-02-01T00:00:00Z' else '2024-01-05T00:00:00Z' end as created_at,
    case when b.ticker is null then '2024-01-05T00:00:00Z' else '2024-02-01T00:00:00Z' end as updated_at
  from one a full join two b on a.ticker = b.ticker left join sums s on s.ticker = b.ticker""")
define("landed_rejects", "raw_posts", """, numbered as (select *, cast(substr(id, 2) as bigint) as n from raw_posts)
  select n % 10 in (3, 7) as has_file,
    case n % 10 when 3 then 'does not parse' when 7 then 'no id' else 'usable' end as reason,
    case when n % 10 = 3 then left('{"id":"' || id || '","title":"  Thread', 20)
      when n % 20 = 7 then left('{"id":"","title":"  Thread', 20)
      when n % 10 = 7 then left('{"title":"  Thread ' || n, 20) else id end as begins from numbered""")
define("flatten_nested", "", """select 'c' || conv_id || 'x' || turn as id, 'p' || conv_id as post_id,
  case when turn = 1 then 't3_p' || conv_id else 't1_c' || conv_id || 'x' || (turn // 2) end as parent_id,
  role as author, md5(text) as body_md5, cast(1704067200 + conv_id * 7200 + turn as bigint) as created_utc,
  cast(turn as integer) as score, cast(turn % 2 as integer) as total_awards_received,
  case when turn % 2 = 1 then 'gold,silver' end as all_awardings,
  case when turn % 3 = 0 then 'wholesome' end as awardings,
  cast(length(bin(turn)) - 1 as integer) as depth from conversations where turn > 0""")
define("branching_depth", "branching", """select reddit_id, parent_reddit_id,
  cast(length(bin(cast(split_part(reddit_id, 'x', 2) as bigint))) - 1 as integer) as depth from branching""")
define("branching_inheritance", "branching direct", """
  , replies as (select distinct * from branching),
  tags as (select kind, content_reddit_id as id, ticker, max(confidence) as confidence from direct
    where kind = 'post' or content_reddit_id like '%x2' group by all),
  untagged as (select * from replies where reddit_id not in (select id from tags where kind = 'comment')),
  taken as (
    select u.reddit_id, u.parent_reddit_id, t.ticker,
      least(cast(0.5 as double), t.confidence * cast(0.8 as double)) as confidence, 1 as distance
    from untagged u join tags t on t.kind = u.parent_kind and t.id = u.parent_reddit_id
    union all
    select u.reddit_id, u.parent_reddit_id, t.ticker,
      least(cast(0.5 as double), t.confidence * cast(0.8 as double)), t.distance + 1
    from untagged u join taken t on u.parent_kind = 'comment' and u.parent_reddit_id = t.reddit_id)
  select reddit_id as content_reddit_id, ticker, round(confidence, 6) as confidence,
    parent_reddit_id as inherited_from, cast(distance as integer) as distance from taken""")
define("symbol_rows", "listed", r"""select '{"symbols":["' || symbol || '"],"updated_at":1.7040672E9}' as value
  from (select distinct symbol from listed where regexp_full_match(symbol, '[\p{L}.]{1,6}')) t""")
define("ticker_list", "event_mentions", "select ticker, count(*) as mentions from event_mentions group by ticker")
define("upsert_mentions", "event_mentions", f"""
  , stored as (select * from event_mentions where method = 'llm' qualify {BEST}),
  latest as (select * from event_mentions where method = 'contextual_inheritance'
    qualify row_number() over (partition by kind, content_reddit_id, ticker order by event_id desc) = 1)
  select coalesce(u.kind, s.kind) as kind, coalesce(u.content_reddit_id, s.content_reddit_id) as content_reddit_id,
    coalesce(u.ticker, s.ticker) as ticker, round(coalesce(u.confidence, s.confidence), 6) as confidence,
    coalesce(u.method, s.method) as method, round(coalesce(u.hype_score, s.hype_score), 6) as hype_score,
    s.company_name
  from stored s full join latest u on s.kind = u.kind and s.content_reddit_id = u.content_reddit_id
    and s.ticker = u.ticker""")
define("clear_counts", "best_events comments posts", """
  select 'content_tickers' as table_name, count(*) as rows_deleted from best_events
  union all select 'comments', count(*) from comments union all select 'posts', count(*) from posts""")
define("evolve_schema", "best_events", """select kind, content_reddit_id, ticker, round(confidence, 6) as confidence,
  cast(0 as double) as hype_score, '' as company_name, cast(null as varchar) as created_at,
  cast(null as varchar) as inheritance_source, cast(null as varchar) as context_post_id from best_events""")
define("schema_tolerant_mentions", "best_events", """select kind, content_reddit_id, ticker,
  round(confidence, 6) as confidence, nullif(span_start, -1) as span_start,
  nullif(span_end, -1) as span_end, method from best_events""")
define("mark_processed", "comments", f"""select reddit_id,
  {iso("coalesce(processed_at, timestamp '2024-01-05')")} as processed_at from comments""")
define("load_symbols", "listed", "select symbol from listed")
define("symbols_json", "listed", r"""select '{"symbols":["' || string_agg(symbol, '","' order by symbol)
  || '"],"updated_at":1.7040672E9}' as value from (select distinct symbol from listed
    where regexp_full_match(symbol, '[\p{L}.]{1,6}')) t""")

define("unprocessed_items", "content", "select kind, reddit_id from content where processed_at is null")
define("processed_items", "content", f"""select kind, reddit_id, {iso('processed_at')} as processed_at
  from content where processed_at is not null""")
define("items_in_range", "content", f"""select kind, reddit_id, {iso('created_utc')} as created_utc from content
  where created_utc >= timestamp '2024-01-02' and created_utc < timestamp '2024-01-06'""")
define("events_in_range", "", """select event_id, event_type from events
  where ts >= timestamp '2024-01-02' and ts < timestamp '2024-01-06'""")
define("analyzable_comments", "comments", f"""select reddit_id, length(body) as body_length from comments
  where body not in ('', '[deleted]', '[removed]')""")
define("post_text", "items", """select reddit_id, md5(text) as text_md5, length(text) as n_chars from items
  where kind = 'post'""")
define("likely_financial", "", r"""select doc_id from documents
  where regexp_matches(upper(source || ' ' || text), '\$|YOLO|CALL|PUT|TSLA|AAPL|NVDA|SPY|META|STOCK')""")
define("oldest_unprocessed", "comments", """select reddit_id, post_reddit_id from comments
  where processed_at is null order by created_utc nulls last, reddit_id limit 100""")
define("sample_comments", "comments", """select reddit_id, left(body, 60) as preview from comments
  order by reddit_id limit 50""")

define("unanalyzed_items", "content direct", """select kind, reddit_id from content c where not exists
  (select 1 from direct d where d.kind = c.kind and d.content_reddit_id = c.reddit_id)""")
define("contextual_inheritance", "inherited", """select content_reddit_id, ticker, round(confidence, 6) as confidence,
  round(hype_score, 6) as hype_score, company_name, method, 'post_context' as inheritance_source,
  context_post_id from inherited""")
define("mentions_with_context", "mentions", """select kind, content_reddit_id, ticker, span_start, span_end,
  round(confidence, 6) as confidence, method, round(hype_score, 6) as hype_score, company_name, context_post_id
  from mentions""")
define("parent_inheritance", "handed", """select reddit_id as content_reddit_id, ticker,
  round(confidence, 6) as confidence, 'inherit' as method, 'inherited' as source,
  parent_reddit_id as inherited_from, cast(distance as integer) as distance from handed""")
define("mentions_on_arrival", "mentions handed", """select kind, content_reddit_id, ticker,
    round(confidence, 6) as confidence, method, round(hype_score, 6) as hype_score from mentions
  union all select 'comment', reddit_id, ticker, round(confidence, 6), 'inherit', cast(0 as double) from handed""")
define("mentions_of_batch", "direct", """select kind, content_reddit_id, ticker, span_start, span_end
  from direct where kind = 'comment'""")
define("valid_tickers", "event_mentions listed", rf"""select event_id, ticker from event_mentions
  where upper({trim('ticker')}) in (select symbol from listed where regexp_full_match(symbol, '[\p{{L}}.]{{1,6}}'))""")
define("ticker_validity", "event_mentions listed", rf"""select event_id, ticker, upper({trim('ticker')}) in
  (select symbol from listed where regexp_full_match(symbol, '[\p{{L}}.]{{1,6}}')) as is_valid from event_mentions""")
define("posts_with_tickers", "posts direct", """select p.reddit_id, p.title, p.score, d.ticker,
  round(d.confidence, 6) as confidence, d.method
  from posts p left join direct d on d.kind = 'post' and d.content_reddit_id = p.reddit_id""")
define("with_company_name", "mentions symbols", """select kind, content_reddit_id, ticker, coalesce(s.name, '') as company_name
  from mentions m left join symbols s on s.symbol = m.ticker""")

define("best_mentions", "best_events", """select kind, content_reddit_id, ticker, round(confidence, 6) as confidence,
  event_id, nullif(span_start, -1) as span_start, nullif(span_end, -1) as span_end, method from best_events""")
for name, source in (("extraction_summary", "direct"), ("event_summary", "event_mentions")):
    define(name, source, f"""select ticker, count(*) filter (kind = 'post') as posts,
      count(*) filter (kind = 'comment') as comments, count(*) as total,
      round(avg(confidence), 6) as avg_confidence,
      (select count(distinct ticker) from {source}) as unique_tickers
      from {source} group by ticker order by total desc, ticker limit 10""")
for name in ("ticker_totals", "merge_ticker_totals", "stream_ticker_totals"):
    define(name, "totals_source", f"""select * replace ({iso('last_mentioned_at')} as last_mentioned_at)
      from ({totals('totals_source')}) t""")
define("running_ticker_hype", "event_mentions", """select upper(ticker) as ticker, event_id,
  count(*) over w as mentions_so_far, round(sum(hype_score) over w, 9) / count(*) over w as avg_hype_so_far,
  round(max(hype_score) over w, 6) as max_hype_so_far from event_mentions
  window w as (partition by upper(ticker) order by created_utc, event_id rows unbounded preceding)""")
define("ticker_leaderboard", "mentions", f"""select ticker, left(company_name, 19) as company, total_mentions,
  total_posts, total_comments, avg_hype_score, max_hype_score from ({totals('mentions')}) t
  order by total_mentions desc, ticker limit 15""")
define("lineitem_leaderboard", "", f"""with rows as (select 'P' || cast(l_suppkey as varchar) as ticker,
    case when l_linenumber = 1 then 'post' else 'comment' end as kind, l_discount * 10 as hype_score,
    'Part ' || l_returnflag || ' of a long company name' as company_name, l_shipdate as created_utc from lineitem)
  select ticker, left(company_name, 19) as company, total_mentions, total_posts, total_comments,
  avg_hype_score, max_hype_score from ({totals('rows')}) t order by total_mentions desc, ticker limit 15""")
define("method_breakdown", "event_mentions", """select coalesce(method, 'unknown') as method, count(*) as mentions
  from event_mentions group by 1""")
define("table_counts", "posts comments best_events", """
  select 'table' as item, 'posts' as name, count(*) as n from posts
  union all select 'table', 'comments', count(*) from comments
  union all select 'table', 'content_tickers', count(*) from best_events
  union all select * from (select 'ticker', ticker, count(*) as n from best_events group by ticker
    order by n desc, ticker limit 5) t""")
define("overall_summary", "event_mentions", """select count(*) as total_extractions,
  count(distinct ticker) as unique_tickers, round(avg(confidence), 6) as avg_confidence,
  (select string_agg(ticker, ', ' order by ticker) from (select distinct ticker from event_mentions) t) as tickers
  from event_mentions""")
define("backfill_scope", "content", """select count(*) filter (kind = 'post') as posts,
  count(*) filter (kind = 'comment') as comments, count(*) as items,
  round(cast(count(*) as double) / 2 / 3600, 6) as estimated_hours,
  round(count(*) * cast(0.001 as double), 6) as estimated_cost, cast(4 as integer) as days
  from content where processed_at is null
    and created_utc >= timestamp '2024-01-02' and created_utc < timestamp '2024-01-06'""")
DAILY = """days as (select unnest(range(date '2024-01-01', date '2024-01-12', interval 1 day)) as day),
  waiting as (select *, date_trunc('day', created_utc) as day from content where processed_at is null),
  hits as (select *, date_trunc('day', created_utc) as day from mentions where processed_at is null
    and (method = 'rule' or context_post_id in (select reddit_id from posts where processed_at is not null
      or created_utc >= timestamp '2024-01-01' and created_utc < timestamp '2024-01-12'))),
  daily as (select strftime(day, '%Y-%m-%d') as day,
    (select count(*) from waiting w where w.day = days.day) as items,
    (select count(*) from hits h where h.day = days.day) as mentions,
    (select count(*) from hits h where h.day = days.day and method = 'contextual_inheritance') as inherited
    from days)"""
for name in ("backfill_daily", "backfill_stored_days"):
    define(name, "content mentions", f", {DAILY} select * from daily")
define("contents_of_listed_days", "content", """select kind, strftime(created_utc, '%Y-%m-%d') as day,
  count(*) as contents, count(distinct reddit_id) as ids from content
  where cast(created_utc as date) in (date '2024-01-03', date '2024-01-09') group by all""")
define("backfill_totals", "content mentions", f""", {DAILY} select count(*) as days,
  cast(sum(items) as bigint) as items, cast(sum(mentions) as bigint) as mentions,
  cast(sum(inherited) as bigint) as inherited from daily""")
define("coverage", "comments mentions", """
  , per as (select c.reddit_id, (select max(case when m.method = 'contextual_inheritance' then 1 else 0 end)
    from mentions m where m.kind = 'comment' and m.content_reddit_id = c.reddit_id) as inherited from comments c)
  select count(*) as comments, count(*) filter (inherited = 0) as direct,
  count(*) filter (inherited = 1) as contextual, count(*) filter (inherited is null) as uncovered,
  round(100 * cast(count(inherited) as double) / count(*), 6) as coverage_pct from per""")
define("resume_date", "content", """select strftime(d, '%Y-%m-%d') as latest_processed,
  strftime(d + interval 1 day, '%Y-%m-%d') as resume_date, d + interval 1 day >= date '2024-02-01' as up_to_date
  from (select date_trunc('day', max(created_utc)) as d from content where processed_at is not null) t
  where d is not null""")
for name in ("ticker_daily_stats", "stream_daily_stats"):
    define(name, "mentions content", """
  , dated as (select *, strftime(created_utc, '%Y-%m-%d') as date from mentions),
  contents as (select distinct d.ticker, d.date, d.kind, d.content_reddit_id, c.score + c.num_comments as engagement
    from dated d join content c on c.kind = d.kind and c.reddit_id = d.content_reddit_id),
  engaged as (select ticker, date, sum(engagement) as engagement from contents group by all)
  select d.ticker, d.date, count(*) as mentions_count, count(*) filter (kind = 'post') as posts_count,
    count(*) filter (kind = 'comment') as comments_count, cast(max(e.engagement) as bigint) as total_engagement,
    round(round(sum(hype_score), 9) / count(*), 2) as avg_hype_score, round(max(hype_score), 2) as max_hype_score
  from dated d join engaged e on e.ticker = d.ticker and e.date is not distinct from d.date
  group by d.ticker, d.date""")
define("symbol_dim", "", rf"""select count(distinct upper({trim("replace(w, 'ß', 'SS')")})) as symbols
  from (select unnest(regexp_split_to_array(text, '[ \n]')) as w from documents) t
  where regexp_full_match(upper({trim("replace(w, 'ß', 'SS')")}), '[\p{{L}}.]{{1,6}}')""")
define("content_union", "content", f"""select kind, reddit_id, post_reddit_id, md5(text) as text_md5,
  {iso('created_utc')} as created_utc from content""")

define("clean_json", "responses", """select r.event_id, case when r.event_id % 8 in (0, 1, 2, 5, 6) then e.props
  else '' end as json from responses r join events e using (event_id)""")
START, END = span_parts("text", "ticker")
define("parse_responses", "ticker_responses", f"""
  , clean as (select *, regexp_extract(trim(response), '(?s)\\{{.*\\}}') as body from ticker_responses),
  parsed as (select c.*, i - 1 as pos, upper(json_extract_string(body, '$.tickers[' || (i - 1) || '].symbol')) as ticker,
    coalesce(json_extract_string(body, '$.tickers[' || (i - 1) || '].name'), '') as company_name,
    coalesce(cast(json_extract_string(body, '$.hype_score') as double), 0) as hype_score
    from clean c, range(1, 3) t(i) where json_valid(body) and i <= json_array_length(body, '$.tickers')),
  places as (select *, {START} as span_start, {END} as span_end from (select distinct text, ticker from parsed) t)
  select reddit_id as content_reddit_id, cast(pos as integer) as pos, ticker, span_start, span_end,
    round({confidence('ticker', 'company_name', 'span_start >= 0')}, 6) as confidence, 'llm' as method,
    round(hype_score, 6) as hype_score, company_name from parsed join places using (text, ticker)""")
define("ticker_span", "", " union all ".join(
    "select doc_id, '{0}' as ticker, {1} as span_start, {2} as span_end from documents".format(
        key, *span_parts("text", f"'{key}'"))
    for key in ("TO", "DER", "NDLY", "THE", "ZZZZ")))
define("extraction_confidence", "event_mentions", f"""select event_id,
  round({confidence('ticker', 'company_name', 'span_start >= 0')}, 6) as extraction_confidence from event_mentions""")
define("lexicon_hype", "content", f"""select id, round({lexicon('text')}, 6) as hype from (
  select 'd' || cast(doc_id as varchar) as id, text from documents
  union all select reddit_id, text from content) t""")
define("contextual_hype", "moods", "select reddit_id, round(hype_score, 6) as hype_score from moods")
define("hype_band", "event_mentions", """select case when h < 0.3 then '0.00-0.29' when h < 0.5 then '0.30-0.49'
    when h < 0.7 then '0.50-0.69' when h < 0.9 then '0.70-0.89' else '0.90-1.00' end as band, count(*) as mentions
  from (select round(greatest(0, least(1, hype_score * cast(1.5 as double))), 2) as h from event_mentions) t
  group by 1""")
define("extract_tickers", "tagged", "select kind, reddit_id, ticker, company_name from tagged")
define("base36_id", "", """select doc_id, count(*) as words, count(v) as ids, cast(sum(v % 1000003) as bigint) as checksum
  from (select doc_id, case when regexp_full_match(w, '0*[0-9a-zA-Z]{1,13}') then
    try_cast(list_reduce(list_transform(string_split(lower(regexp_extract(w, '^0*(.{1,13})$', 1)), ''),
      lambda c: cast(strpos('0123456789abcdefghijklmnopqrstuvwxyz', c) - 1 as hugeint)), lambda a, b: a * 36 + b) as bigint) end as v
    from (select doc_id, unnest(regexp_split_to_array(text, '[ \\n]')) as w from documents) u) t group by doc_id""")
define("parent_id", "raw_comments", """select post_id, created_utc,
  nullif(regexp_extract(parent_id, '^[^_]*_(.*)$', 1), '') as parent_reddit_id,
  case when parent_id like 't3!_%' escape '!' then 'post' when parent_id like 't1!_%' escape '!' then 'comment' end
    as parent_kind from raw_comments""")

define("stream_upsert_posts", "landings", f"""select id as reddit_id, {trim('title')} as title,
  md5({trim('selftext')}) as text_md5, author, score from landings
  qualify row_number() over (partition by id order by landed_at desc) = 1""")
define("stream_upsert_comments", "comment_landings", f"""select id as reddit_id, post_id as post_reddit_id, author,
  md5({trim('body')}) as body_md5, score, array_to_string(coalesce(all_awardings, awardings, []), ',') as awards
  from comment_landings qualify row_number() over (partition by id order by landed_at desc) = 1""")
define("stream_edits", "direct", """select kind, content_reddit_id, ticker, span_start, span_end,
  round(confidence, 6) as confidence, round(hype_score, 6) as hype_score from direct""",
  content=f"select * replace ({adapters.EDITS[3]} as text) from ({PARTS['content']}) t")
define("stream_mentions", "direct", """select kind, content_reddit_id, ticker, span_start, span_end,
  round(confidence, 6) as confidence, round(hype_score, 6) as hype_score from direct""")
define("stream_contextual", "inherited", """select content_reddit_id, ticker, round(confidence, 6) as confidence,
  round(hype_score, 6) as hype_score, context_post_id from inherited""")
STUB = r"""
  , answered as (select i.*, case when contains(text, 'risky') then 'no JSON in the response'
      when contains(text, 'holding') then 'ValueError: refused' end as error from items i),
  hits as (select kind, reddit_id, text, ticker, cast(row_number() over (partition by kind, reddit_id order by o) - 1
      as integer) as pos from answered, (values ('TSLA', 1), ('GME', 2)) s(ticker, o)
    where error is null and contains(text, ticker)),
  """
define("score_with_stub", "items", f"""{STUB}
  spans as (select *, {START} as span_start, {END} as span_end from hits)
  select kind, reddit_id as content_reddit_id, pos, ticker, span_start, span_end,
    round({confidence('ticker', "''", 'span_start >= 0')}, 6) as confidence, cast(0.5 as double) as hype_score
  from spans""")
define("score_errors", "items", STUB.rstrip().rstrip(",") + """
  select kind, reddit_id, error from answered where error is not null""")
define("hype_with_stub", "comments direct", f"""select reddit_id, cast(case when length(body) < 3 or contains(body, 'risky')
    then 0 when contains(body, '🚀') then 1 else 0.25 end as double) as hype_score
  from comments where body not in ('', '[deleted]', '[removed]')
    and reddit_id not in (select content_reddit_id from direct where kind = 'comment')
    and post_reddit_id in (select content_reddit_id from direct where kind = 'post')""")
define("run_summary", "items mentions", """select (select count(*) from items where processed_at is null) as analyzed_items,
  count(*) as mentions, count(*) filter (method = 'contextual_inheritance') as inherited,
  count(*) filter (method <> 'contextual_inheritance') as direct
  from mentions where processed_at is null""")
ORACLE["score_with_ledger"] = ORACLE["score_with_stub"]
ORACLE["upsert_daily_stats"] = f"select * from ({ORACLE['ticker_daily_stats']}) t where date is not null"
