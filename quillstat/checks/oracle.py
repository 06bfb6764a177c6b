"""SQL twins of the registered queries, for DuckDB on the driver's tables.

Written apart from the pipelines and with other means where there are some:
integer cents instead of decimals, plain windows and joins on the full tables
instead of salted, pre-aggregated or pre-filtered ones.
"""

from __future__ import annotations

import re

from quillstat.checks.roles import CREATORS, PROBED
from quillstat.fixed_values import CURRENCIES, ENGAGEMENT_POINTS, HIGH_VALUE_TYPES

_ADDRESS = {c.label: c.address for c in CURRENCIES}
_IDS = ", ".join(f"('{i}')" for i in CREATORS)
_RATES = ", ".join(
    f"('{c.address}', '{c.label}', CAST(round({c.rate} * 100) AS BIGINT), {c.decimals})"
    for c in CURRENCIES
)


def _modules(publication: str, extra: str = "") -> str:
    return f"""
    SELECT CAST({publication} AS VARCHAR) AS publication_id,
      CASE l_returnflag || l_linestatus
        WHEN 'AO' THEN '{_ADDRESS["WETH"]}' WHEN 'AF' THEN '{_ADDRESS["NCT"]}'
        WHEN 'RO' THEN '{_ADDRESS["WMATIC"]}' WHEN 'RF' THEN '{_ADDRESS["DAI"]}'
        WHEN 'NO' THEN '{_ADDRESS["USDC"]}' ELSE '0xunlisted' END AS currency,
      CASE l_returnflag || l_linestatus
        WHEN 'NF' THEN c
        WHEN 'NO' THEN c * 10000 + n * 1000
        ELSE c * 10000000000000000 + n * 1000000000000000 END AS amount{extra}
    FROM (SELECT *, CAST(round(l_extendedprice * 100) AS HUGEINT) AS c,
            CAST(l_partkey % 10 AS HUGEINT) AS n FROM lineitem)"""


# Cents of one module row, rounded half up by integer division.
def _cents(amount: str, decimals: str) -> str:
    return f"""CASE {decimals}
        WHEN 18 THEN ({amount} + 5000000000000000) // 10000000000000000
        WHEN 6 THEN ({amount} + 5000) // 10000
        ELSE {amount} * 100 END"""


_STATS_ID = "CASE WHEN c_custkey % 5 = 0 THEN 'x' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END"

ROLES = {
    "allowlist": f"SELECT * FROM (VALUES {_IDS}) AS v(profile_id)",
    "rates": f"SELECT * FROM (VALUES {_RATES}) AS v(address, label, hundredths, decimals)",
    "post_v1": """
    SELECT CAST(o_custkey % 100 AS VARCHAR) AS profile_id, CAST(o_orderkey AS VARCHAR) AS post_id,
      o_orderdate AS ts FROM orders""",
    "collect_module_v1": _modules("l_orderkey + 7", ", l_tax AS referral_fee"),
    "collect_record_v1": """
    SELECT CAST(event_id // 2 AS VARCHAR) AS publication_id, ts,
      CASE WHEN user_id % 11 = 0 THEN NULL WHEN user_id % 5 = 0 THEN 'u' || user_id
        ELSE 'w' || user_id END AS collected_by,
      CAST(event_id AS VARCHAR) AS referral_id FROM events""",
    "profile_v1": """
    SELECT CAST(c_custkey AS VARCHAR) AS profile_id, 'w' || (c_custkey // 2) AS owned_by,
      c_name AS handle FROM customer""",
    "profile_stats_v1": f"""
    SELECT {_STATS_ID} AS profile_id,
      CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(floor(c_acctbal) AS BIGINT) END
        AS total_collects FROM customer""",
    "profile_record": """
    SELECT CAST(c_custkey AS VARCHAR) AS profile_id, 'w' || (c_custkey // 2) AS owned_by,
      c_acctbal < 0 AS is_burnt,
      DATE '1995-01-01' + CAST(c_custkey % 700 AS INTEGER) AS day FROM customer""",
    "profile_metadata": """
    SELECT CASE WHEN o_custkey % 7 = 0 THEN 'x' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END
        AS profile_id,
      CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority || '#' || o_orderkey END AS name,
      o_orderdate AS ts FROM orders""",
    "logins": "SELECT CAST(user_id AS VARCHAR) AS profile_id, ts FROM events",
    "profile_totals": f"""
    SELECT {_STATS_ID} AS profile_id,
      c_custkey % 101 AS profile_posts, c_custkey % 103 AS profile_comments,
      c_custkey % 107 AS profile_mirrors, c_custkey % 109 AS profile_quotes,
      c_custkey % 113 AS profile_publications, c_custkey % 127 AS profile_reacted,
      c_custkey % 131 AS profile_reactions, c_custkey % 137 AS profile_collects,
      c_custkey % 139 AS profile_acted, c_custkey % 149 AS profile_followers,
      c_custkey % 151 AS profile_following, (c_custkey % 1000) / 8 AS score
    FROM customer""",
    "publication_record": """
    SELECT CAST(o_orderkey AS VARCHAR) AS publication_id,
      CAST(o_custkey % 100 AS VARCHAR) AS profile_id,
      CASE o_orderpriority WHEN '2-HIGH' THEN 'COMMENT' WHEN '3-MEDIUM' THEN 'MIRROR'
        WHEN '4-NOT SPECIFIED' THEN 'QUOTE' ELSE 'POST' END AS publication_type,
      CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN NULL
        WHEN o_orderstatus = 'P' THEN o_orderkey + 1000000000
        ELSE o_orderkey // 3 END AS VARCHAR) AS parent_publication_id,
      o_orderstatus AS app, o_totalprice < 50000 AS is_hidden, o_orderkey % 3 = 0 AS is_momoka,
      o_orderkey % 17 = 0 AS gardener_flagged, o_orderdate AS ts
    FROM orders""",
    "publication_metadata": """
    SELECT CAST(doc_id AS VARCHAR) AS publication_id, lang AS language,
      CASE WHEN n_chars >= 500 THEN 'LONG' END AS content_warning, source,
      n_chars % 2 = 0 AS is_encrypted
    FROM documents""",
    "publication_stats": """
    SELECT CAST(l_orderkey AS VARCHAR) AS publication_id, count(*) AS collects,
      CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS mirrors,
      CAST(max(l_linenumber) AS BIGINT) AS comments, CAST(min(l_linenumber) AS BIGINT) AS quotes,
      CAST(sum(l_suppkey) AS BIGINT) AS reactions, CAST(sum(l_partkey) AS BIGINT) AS bookmarks,
      max(l_suppkey) AS acted, min(l_partkey) AS gardeners
    FROM lineitem GROUP BY l_orderkey""",
    "action_module": _modules("l_orderkey"),
    "acted_record": """
    SELECT CAST(event_id * 2 AS VARCHAR) AS publication_id, CAST(user_id AS VARCHAR) AS actor,
      CASE event_type WHEN 'purchase' THEN TRUE WHEN 'click' THEN TRUE WHEN 'error' THEN NULL
        ELSE FALSE END AS is_collect, ts
    FROM events""",
    "ownership_history": """
    SELECT CAST(l_suppkey AS VARCHAR) AS profile_id, 'w' || l_partkey AS owned_by,
      l_shipdate AS ts FROM lineitem""",
    "handles": """
    SELECT 'w' || (p_partkey // 3) AS owned_by, p_brand || '#' || p_size AS handle,
      CAST(DATE '2000-01-01' + CAST(p_partkey % 3000 AS INTEGER) AS TIMESTAMP) AS ts
    FROM part""",
}

_TIME = "strftime({0}, '%H:%M:%S.%f')"


def _branch(
    publication: str,
    profile: str,
    ts: str,
    actor: str,
    kind: str,
    origin: str = "CAST(NULL AS VARCHAR)",
    app: str = "CAST(NULL AS VARCHAR)",
    language: str = "CAST(NULL AS VARCHAR)",
    units: str = "0",
) -> str:
    return f"""
    SELECT {publication} AS publication_id, {profile} AS profile_id,
      CAST({ts} AS DATE) AS interaction_date, {_TIME.format(ts)} AS interaction_time,
      {actor} AS interaction_profile_id, {origin} AS interaction_publication_id,
      {app} AS interaction_app, {language} AS interaction_language,
      {kind} AS interaction_type, CAST({units} AS HUGEINT) AS units"""


_NO_ID = "CAST(NULL AS VARCHAR)"
_BRANCHES = ("follows", "derivatives", "collects_v2", "collects_v1", "reactions", "mentions")

PRODUCTS = {
    "scaled": f"""
    SELECT m.publication_id, coalesce(r.label, m.currency) AS currency,
      {_cents("m.amount", "r.decimals")} AS cents
    FROM action_module m LEFT JOIN rates r ON r.address = m.currency""",
    "revenue_v2": """
    SELECT s.publication_id, s.currency, s.cents, s.cents * coalesce(r.hundredths, 100) AS units
    FROM (SELECT publication_id, currency, CAST(sum(cents) AS HUGEINT) AS cents
          FROM scaled GROUP BY publication_id, currency) s
    LEFT JOIN rates r ON r.label = s.currency""",
    "top_profile": """
    SELECT owned_by, profile_id, handle
    FROM (SELECT p.owned_by, p.profile_id, p.handle, row_number() OVER (
            PARTITION BY p.owned_by ORDER BY s.total_collects DESC NULLS LAST, p.profile_id) AS rn
          FROM profile_v1 p LEFT JOIN profile_stats_v1 s ON s.profile_id = p.profile_id)
    WHERE rn = 1""",
    "ledger": f"""
    SELECT p.profile_id, p.post_id, p.ts AS publication_date, c.ts AS collect_date,
      t.profile_id AS profile_id_collected, t.handle AS collected_by,
      coalesce(r.label, m.currency) AS currency, {_cents("m.amount", "r.decimals")} AS cents,
      m.referral_fee AS referral_fee_pct, c.referral_id
    FROM post_v1 p
    LEFT JOIN collect_module_v1 m ON m.publication_id = p.post_id
    LEFT JOIN rates r ON r.address = m.currency
    LEFT JOIN collect_record_v1 c ON c.publication_id = p.post_id
    LEFT JOIN top_profile t ON t.owned_by = c.collected_by""",
    "revenue_v1": """
    SELECT post_id, currency, CAST(sum(cents) AS HUGEINT) AS cents
    FROM ledger GROUP BY post_id, currency""",
    "latest_name": """
    SELECT profile_id, name
    FROM (SELECT profile_id, name, row_number() OVER (
            PARTITION BY profile_id ORDER BY ts DESC, name DESC NULLS LAST) AS rn
          FROM profile_metadata)
    WHERE rn = 1""",
    "profiles": f"""
    SELECT p.profile_id, n.name AS profile_name, p.owned_by AS profile_address,
      p.is_burnt AS profile_burnt_flag, CAST(max(l.ts) AS DATE) AS profile_last_logged_in_date,
      {_TIME.format("max(l.ts)")} AS profile_last_logged_in_time,
      p.day AS profile_creation_date, t.* EXCLUDE (profile_id)
    FROM profile_record p
    LEFT JOIN latest_name n ON n.profile_id = p.profile_id
    LEFT JOIN logins l ON l.profile_id = p.profile_id
    LEFT JOIN profile_totals t ON t.profile_id = p.profile_id
    GROUP BY ALL""",
    "publications": f"""
    SELECT p.publication_id, p.profile_id, p.publication_type,
      p.is_hidden AS publication_hidden_flag, p.is_momoka AS publication_momoka_flag,
      p.gardener_flagged AS publication_gardener_flagged_flag, p.app AS publication_app,
      m.language AS publication_language, m.content_warning AS publication_content_warning,
      m.source AS publication_main_content_focus, m.source AS publication_tags_vector,
      m.is_encrypted AS publication_encryption_flag,
      coalesce(r.currency, f.currency) AS publication_currency,
      CAST(coalesce(r.cents, f.cents) AS DOUBLE) / 100 AS publication_revenue,
      CAST(p.ts AS DATE) AS publication_date, {_TIME.format("p.ts")} AS publication_time,
      s.collects AS publication_total_collects, s.mirrors AS publication_total_mirrors,
      s.comments AS publication_total_comments, s.quotes AS publication_total_quotes,
      s.reactions AS publication_total_reactios, s.bookmarks AS publication_total_bookmarks,
      s.acted AS publication_total_acted, s.gardeners AS publication_total_comments_gardeners,
      CAST(date_trunc('month', p.ts) AS DATE) AS publication_date_year_month
    FROM publication_record p
    LEFT JOIN publication_metadata m ON m.publication_id = p.publication_id
    LEFT JOIN revenue_v2 r ON r.publication_id = p.publication_id
    LEFT JOIN publication_stats s ON s.publication_id = p.publication_id
    LEFT JOIN revenue_v1 f ON f.post_id = p.publication_id""",
    "follows": _branch(
        _NO_ID,
        "CAST(event_id % 100 AS VARCHAR)",
        "ts",
        "CAST(user_id AS VARCHAR)",
        "'FOLLOW'",
    )
    + " FROM events",
    "derivatives": _branch(
        "o.publication_id",
        "o.profile_id",
        "c.ts",
        "c.profile_id",
        "c.publication_type",
        "c.publication_id",
        "c.app",
        "m.language",
    )
    + """
    FROM publication_record c
    LEFT JOIN publication_metadata m ON m.publication_id = c.publication_id
    LEFT JOIN publication_record o ON o.publication_id = c.parent_publication_id
    WHERE c.parent_publication_id IS NOT NULL""",
    "collects_v2": _branch(
        "a.publication_id",
        "o.profile_id",
        "a.ts",
        "a.actor",
        """CASE WHEN a.is_collect THEN
        CASE WHEN m.amount > 0 THEN 'PAID COLLECT' ELSE 'FREE COLLECT' END END""",
        units="r.units",
    )
    + """
    FROM acted_record a
    LEFT JOIN publication_record o ON o.publication_id = a.publication_id
    LEFT JOIN action_module m ON m.publication_id = a.publication_id
    LEFT JOIN revenue_v2 r ON r.publication_id = a.publication_id""",
    "collects_v2_apart": _branch(
        "a.publication_id",
        "o.profile_id",
        "a.ts",
        "a.actor",
        """CASE WHEN a.is_collect THEN
        CASE WHEN m.amount > 0 THEN 'PAID COLLECT' ELSE 'FREE COLLECT' END END""",
        units="r.units",
    )
    + """
    FROM acted_record a
    LEFT JOIN publication_record o ON o.publication_id = a.publication_id
    LEFT JOIN action_module m ON m.publication_id = a.publication_id
    LEFT JOIN revenue_apart r ON r.publication_id = a.publication_id""",
    "revenue_apart": """
    SELECT CAST(CAST(publication_id AS BIGINT) + 3 AS VARCHAR) AS publication_id, units
    FROM revenue_v2""",
    "collects_v1": _branch(
        "l.post_id",
        "l.profile_id",
        "l.collect_date",
        "l.profile_id_collected",
        "CASE WHEN l.cents > 0 THEN 'PAID COLLECT' ELSE 'FREE COLLECT' END",
        units="coalesce(l.cents, 0) * coalesce(r.hundredths, 100)",
    )
    + """
    FROM ledger l LEFT JOIN rates r ON r.label = l.currency
    WHERE l.collect_date IS NOT NULL""",
    "reactions": _branch(
        "CAST(e.event_id * 2 AS VARCHAR)",
        "o.profile_id",
        "e.ts",
        "CAST(e.user_id AS VARCHAR)",
        "CASE e.event_type WHEN 'error' THEN 'DOWNVOTE' ELSE 'UPVOTE' END",
        app="e.event_type",
    )
    + """
    FROM events e
    LEFT JOIN publication_record o ON o.publication_id = CAST(e.event_id * 2 AS VARCHAR)""",
    "mentions": _branch(
        _NO_ID,
        "CAST(e.event_id % 100 AS VARCHAR)",
        "e.ts",
        "o.profile_id",
        "'MENTION'",
        "CAST(e.event_id * 2 AS VARCHAR)",
        "o.app",
        "m.language",
    )
    + """
    FROM events e
    LEFT JOIN publication_record o ON o.publication_id = CAST(e.event_id * 2 AS VARCHAR)
    LEFT JOIN publication_metadata m ON m.publication_id = o.publication_id""",
    "interactions": " UNION ALL ".join(f"SELECT * FROM {b}" for b in _BRANCHES),
    "creator_interactions": "SELECT i.* FROM interactions i JOIN allowlist USING (profile_id)",
    "creator_publications": "SELECT p.* FROM publications p JOIN allowlist USING (profile_id)",
    "history": """
    SELECT o.profile_id, r.profile_id AS profile_record_id, o.owned_by AS ownership_owner,
      h.owned_by AS handle_owner, r.owned_by AS record_owner, h.handle, h.ts AS handle_time,
      o.ts AS block_timestamp
    FROM (SELECT profile_id, owned_by, max(ts) AS ts
          FROM ownership_history GROUP BY profile_id, owned_by) o
    LEFT JOIN handles h ON h.owned_by = o.owned_by
    LEFT JOIN profile_record r ON r.owned_by = h.owned_by""",
}

_ALL = {**ROLES, **PRODUCTS}


def _usd(units: str) -> str:
    """Units of 10^-4 USD as USD, rounded half up to cents."""
    return f"CAST(({units} + 50) // 100 AS DOUBLE) / 100"


def _interactions(source: str, month: bool = False) -> str:
    extra = ", CAST(date_trunc('month', interaction_date) AS DATE) AS interaction_date_year_month"
    return f"""SELECT * EXCLUDE (units), {_usd("units")} AS amount_USD{extra if month else ""}
    FROM {source}"""


_MEASURES = f"""count(DISTINCT interaction_profile_id) AS number_user,
      count(*) AS number_interaction, {_usd("CAST(sum(units) AS HUGEINT)")} AS revenue_USD"""
_POINTS = " ".join(f"WHEN '{k}' THEN {v}" for k, v in ENGAGEMENT_POINTS.items())
_HIGH = ", ".join(f"'{k}'" for k in HIGH_VALUE_TYPES)
_ORDER = """ORDER BY block_timestamp, profile_id, ownership_owner, handle NULLS FIRST,
        handle_time NULLS FIRST, profile_record_id NULLS FIRST"""


def _history(where: str, extra: str = "") -> str:
    return f"""
    SELECT {extra} profile_id, profile_record_id, ownership_owner, handle_owner, record_owner, handle,
      strftime(block_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS block_timestamp,
      row_number() OVER (PARTITION BY profile_id {_ORDER}) > 1 AS profile_changed_flag,
      row_number() OVER (PARTITION BY handle {_ORDER}) > 1 AS address_changed_flag
    FROM history {where}"""


QUERIES = {
    "date_dimension": """
    SELECT CAST(d AS DATE) AS date
    FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d
          FROM (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi
                FROM publication_record))""",
    "creator_allowlist": """
    SELECT profile_id, owned_by, is_burnt FROM profile_record
    WHERE profile_id IN (SELECT profile_id FROM allowlist)""",
    "fx_rates": """
    SELECT s.currency, s.modules, CAST(r.hundredths AS DOUBLE) / 100 AS rate,
      r.label IS NOT NULL AS rate_known
    FROM (SELECT currency, count(*) AS modules FROM scaled GROUP BY currency) s
    LEFT JOIN rates r ON r.label = s.currency""",
    "amount_scaling": """
    SELECT publication_id, currency, CAST(cents AS DOUBLE) / 100 AS amount FROM scaled""",
    "revenue_v2": f"""
    SELECT publication_id, currency, CAST(cents AS DOUBLE) / 100 AS amount,
      {_usd("units")} AS amount_USD FROM revenue_v2""",
    "latest_profile_metadata": "SELECT profile_id, name FROM latest_name",
    "top_profile_per_owner": "SELECT owned_by, profile_id, handle FROM top_profile",
    "collect_ledger_v1": """
    SELECT profile_id, post_id, epoch_us(publication_date) AS publication_date,
      epoch_us(collect_date) AS collect_date, profile_id_collected, collected_by, currency,
      CAST(cents AS DOUBLE) / 100 AS amount, referral_fee_pct, referral_id FROM ledger""",
    "revenue_v1": """
    SELECT post_id, currency, CAST(cents AS DOUBLE) / 100 AS amount FROM revenue_v1""",
    "profile_dimension": "SELECT * FROM profiles",
    "publication_fact": "SELECT * FROM publications",
    "interaction_follow": _interactions("follows"),
    "interaction_derivative": _interactions("derivatives"),
    "interaction_collect_v2": _interactions("collects_v2"),
    "collect_v2_staged_apart": _interactions("collects_v2_apart"),
    "interaction_collect_v1": _interactions("collects_v1"),
    "interaction_reaction": _interactions("reactions"),
    "interaction_mention": _interactions("mentions"),
    "interaction_log": _interactions("interactions", month=True),
    "interaction_log_partitioned": _interactions("interactions", month=True),
    "micros_roundtrip": """
    SELECT CAST(event_id AS VARCHAR) AS referral_id,
      strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS block_timestamp FROM events""",
    "creator_publications": "SELECT * FROM creator_publications",
    "creator_interactions": _interactions("creator_interactions", month=True),
    "profile_check": """
    SELECT CAST(sum(n) AS BIGINT) AS number_row, count(*) AS number_profile,
      count(*) FILTER (WHERE n > 1) AS number_repeated
    FROM (SELECT profile_id, count(*) AS n FROM profiles GROUP BY profile_id)""",
    "profile_mart": "SELECT * FROM profiles",
    "interactions_by_month": f"""
    SELECT profile_id, substring(CAST(interaction_date AS VARCHAR), 1, 7) AS year_month,
      interaction_type, {_MEASURES}
    FROM creator_interactions GROUP BY ALL""",
    "publications_by_month": """
    SELECT profile_id, substring(CAST(publication_date AS VARCHAR), 1, 7) AS year_month,
      publication_type, count(*) AS number_publication
    FROM creator_publications GROUP BY ALL""",
    "user_analysis": f"""
    SELECT i.interaction_profile_id AS user_id, p.profile_name, i.profile_id,
      min(i.interaction_date) AS first_interaction_date,
      max(i.interaction_date) AS last_interaction_date,
      count(DISTINCT p.profile_id || '_' || i.interaction_type) AS number_interaction,
      CASE WHEN i.interaction_type IN ({_HIGH}) THEN 'high_value' ELSE 'low_value' END
        AS interaction_category,
      CAST(sum(CASE i.interaction_type {_POINTS} ELSE 0 END) AS BIGINT) AS user_score,
      {_usd("CAST(sum(i.units) AS HUGEINT)")} AS amount_USD
    FROM creator_interactions i JOIN profiles p ON p.profile_id = i.interaction_profile_id
    WHERE p.profile_name IS NOT NULL
    GROUP BY ALL""",
    "interaction_weekday_hour": f"""
    SELECT profile_id, interaction_type,
      isodow(interaction_date) || '-' || dayname(interaction_date) AS weekday,
      CAST(substring(interaction_time, 1, 2) AS INTEGER) AS hour, {_MEASURES}
    FROM creator_interactions GROUP BY ALL""",
    "interactions_by_age": f"""
    SELECT profile_id, publication_id, interaction_type, day_since_creation, {_MEASURES}
    FROM (SELECT i.*, CAST(date_diff('day', d.publication_date, i.interaction_date) AS INTEGER)
            AS day_since_creation
          FROM creator_interactions i
          LEFT JOIN (SELECT DISTINCT publication_id, publication_date FROM creator_publications) d
            ON d.publication_id = i.publication_id)
    GROUP BY ALL""",
    "handle_history": _history(""),
    "handle_history_probe": _history(
        f"WHERE profile_id IN ({', '.join(repr(i) for i in PROBED)})",
        "strftime(handle_time, '%Y-%m-%d %H:%M:%S.%f') AS handle_time,",
    ),
}
QUERIES["refreshed_interactions_by_month"] = QUERIES["interactions_by_month"]


def sql(name: str) -> str:
    """A query with the roles and products it uses, each as a common table."""
    body = QUERIES[name]
    needed: list[str] = []

    def need(text: str) -> None:
        for table in _ALL:
            if table not in needed and re.search(rf"\b(FROM|JOIN)\s+{table}\b", text):
                need(_ALL[table])
                needed.append(table)

    need(body)
    tables = ",\n".join(f"{t} AS ({_ALL[t]})" for t in needed)
    return f"WITH {tables}\n{body}" if tables else body
