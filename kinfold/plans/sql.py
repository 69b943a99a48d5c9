"""Building blocks of the oracle SQL (DuckDB)."""

from __future__ import annotations

from ..functions import constants as C


def _list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def norm_text(c: str, amp: bool = True) -> str:
    low = f"lower(coalesce({c}, ''))"
    return f"trim(regexp_replace({f"replace({low}, '&', ' and ')" if amp else low}, '[^a-z0-9]+', ' ', 'g'))"


def words(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda w: w <> '')"


def norm_name(c: str, amp: bool = True, legal=C.LEGAL_FORMS) -> str:
    return f"coalesce(array_to_string(list_filter({words(norm_text(c, amp))}, lambda w: w NOT IN {_list(legal)}), ' '), '')"


def norm_address(c: str) -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in C.ABBREVIATIONS.items())
    return f"coalesce(array_to_string(list_transform({words(norm_text(c))}, lambda w: CASE w {cases} ELSE w END), ' '), '')"


def tokens(c: str) -> str:
    return f"list_sort(list_distinct({words(c)}))"


def by_length(a: str) -> str:
    return f"list_transform(list_sort(list_transform({a}, lambda w: {{'n': -length(w), 'w': w}})), lambda s: s.w)"


def shortest(a: str, n: int) -> str:
    return f"list_transform(list_sort(list_transform({a}, lambda w: {{'n': length(w), 'w': w}}))[1:{n}], lambda s: s.w)"


def salient(a: str) -> str:
    return by_length(f"list_filter({a}, lambda w: length(w) >= 4 AND w NOT IN {_list(C.GENERIC_TOKENS)} AND w NOT IN {_list(C.LEGAL_FORMS)})")


def key_token(a: str) -> str:
    return f"({by_length(f'list_filter({a}, lambda w: length(w) >= 4 AND w NOT IN {_list(C.LEGAL_FORMS)})')})[1]"


def address_words(a: str, least: int = 5, stop=C.ADDRESS_STOP_WORDS) -> str:
    return f"list_filter({a}, lambda w: length(w) >= {least} AND w NOT IN {_list(stop)})"


def grams(c: str, n: int = 3, pad: bool = True) -> str:
    s = f"(' ' || {c} || ' ')" if pad else c
    return f"CASE WHEN length({c}) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(1, 1 + greatest(length({s}) - {n - 1}, 1)), lambda i: substr({s}, i, {n})))) END"


def postal(c: str) -> str:
    return f"list_sort(list_distinct(regexp_extract_all({c}, '\\b\\d{{5,6}}\\b')))"


def first_postal(c: str) -> str:
    return f"regexp_extract({c}, '\\b\\d{{5,6}}\\b')"


def with_country(a: str) -> str:
    return f"list_transform({a}, lambda w: country_n || ':' || w)"


def number(c: str) -> str:
    return f"coalesce(TRY_CAST(regexp_extract({c}, '([0-9]+)$', 1) AS BIGINT), 0)"


def lcs(a: str, b: str) -> str:
    """Longest common subsequence by rows of the dynamic programme."""
    return (
        f"list_reduce(string_split({a}, ''), lambda prev, ca: list_reduce(range(1, length({b}) + 1), lambda acc, j: list_append(acc, "
        f"CASE WHEN ca = substr({b}, j, 1) THEN prev[j] + 1 ELSE greatest(acc[j], prev[j + 1]) END), [0]), list_transform(range(0, length({b}) + 1), lambda i: 0))[length({b}) + 1]"
    )


def indel(a: str, b: str) -> str:
    return f"CASE WHEN {a} = {b} THEN 1.0 WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE 2.0 * {lcs(a, b)} / (length({a}) + length({b})) END"


def jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b})) / (len({a}) + len({b}) - len(list_intersect({a}, {b})))::DOUBLE END"


def containment(a: str, b: str) -> str:
    return (
        f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 WHEN contains({b}, {a}) THEN length({a}) / length({b})::DOUBLE "
        f"WHEN contains({a}, {b}) THEN length({b}) / length({a})::DOUBLE ELSE 0.0 END"
    )


def overlap(a: str, b: str) -> str:
    return f"len(list_intersect({a}, {b})) / greatest(1, least(len({a}), len({b})))::DOUBLE"


#: Common table expressions of the record views; q: reference records, t: targets.
RECORDS = """records AS (
  SELECT doc_id AS ord, 'S' || (1 + doc_id % 3) AS feed, 'S' || (1 + doc_id % 3) || '-' || doc_id AS entity_id,
         coalesce(array_to_string(string_split(text, ' ')[1:4], ' '), '') AS business_name,
         coalesce(array_to_string(string_split(text, ' ')[5:14], ' '), '') || ' ' || (10000 + n_chars % 50) AS business_address,
         lang AS country, left(text, 60) AS lead FROM documents)"""
#: The same records in the order of their feed files.
FILE_RECORDS = RECORDS.replace("SELECT doc_id AS ord,", "SELECT row_number() OVER (ORDER BY doc_id % 3, doc_id) AS ord,", 1)
PART_RECORDS = """records AS (
  SELECT p_partkey AS ord, 'S' || (1 + p_partkey % 3) AS feed, 'S' || (1 + p_partkey % 3) || '-' || p_partkey AS entity_id,
         p_name AS business_name, p_type AS business_address, p_brand AS country FROM part)"""
PREPARED = f"""normal AS (
  SELECT ord, feed, entity_id, {norm_name('business_name')} AS name_n, {norm_address('business_address')} AS addr_n, {norm_text('country')} AS country_n FROM records
), prepared AS (SELECT *, {tokens('name_n')} AS name_tokens, {tokens('addr_n')} AS addr_tokens FROM normal
), q AS (SELECT * FROM prepared WHERE feed = 'S1'), t AS (SELECT * FROM prepared WHERE feed <> 'S1')"""
TRUTH = """truth AS (
  SELECT a.entity_id AS s1, b.entity_id AS cid FROM records a JOIN records b ON a.lead = b.lead AND a.ord // 1000 = b.ord // 1000 AND a.feed = 'S1' AND b.feed <> 'S1')"""
LISTS = """truth_lists AS (
  SELECT r.ord, r.entity_id AS source1_entity_id, coalesce(string_agg(cid, ',' ORDER BY cid), '') AS matched_entity_ids
  FROM records r LEFT JOIN truth ON s1 = entity_id WHERE r.feed = 'S1' GROUP BY r.ord, r.entity_id)"""
PAIRS = "s1 AS source1_entity_id, cid AS candidate_entity_id"
BLOCK = f"{PAIRS}, ord, block_type, blocking_key"


def postings(name: str, key: str, cap: int | None, array: bool = False, source: str = "t") -> str:
    """CTE name(key, ord, cid): the first `cap` targets of each key."""
    rows = f"SELECT unnest({key}) AS key, ord, entity_id AS cid FROM {source}" if array else f"SELECT {key} AS key, ord, entity_id AS cid FROM {source}"
    ranked = f"SELECT *, row_number() OVER (PARTITION BY key ORDER BY ord) AS rn FROM ({rows}) WHERE key IS NOT NULL"
    return f"{name} AS (SELECT key, ord, cid FROM ({ranked}){'' if cap is None else f' WHERE rn <= {cap}'})"


def probes(name: str, key: str, array: bool = False, source: str = "q") -> str:
    rows = f"SELECT unnest({key}) AS key, entity_id AS s1 FROM {source}" if array else f"SELECT {key} AS key, entity_id AS s1 FROM {source}"
    return f"{name} AS (SELECT * FROM ({rows}) WHERE key IS NOT NULL)"


def block(name: str, q_key: str, t_key: str, cap: int, label: str, q_array: bool = False, t_array: bool = False, source: str = "q") -> str:
    """CTEs of a capped block; the last is `name`(s1, cid, ord, block_type, blocking_key)."""
    return (
        f"{postings(name + '_t', t_key, cap, t_array)},\n{probes(name + '_q', q_key, q_array, source)},\n"
        f"{name} AS (SELECT s1, cid, ord, '{label}' AS block_type, key AS blocking_key FROM {name}_q JOIN {name}_t USING (key))"
    )


def by_hits(name: str, q_key: str, t_key: str, per_key: int, take: int, label: str, source: str = "q") -> str:
    return (
        f"{postings(name + '_t', t_key, per_key, True)},\n{probes(name + '_q', q_key, True, source)},\n"
        f"{name}_h AS (SELECT s1, cid, ord, count(*) AS hits FROM {name}_q JOIN {name}_t USING (key) GROUP BY ALL),\n"
        f"{name} AS (SELECT s1, cid, ord, '{label}' AS block_type, CAST(hits AS VARCHAR) AS blocking_key FROM "
        f"(SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY hits DESC, ord) AS rn FROM {name}_h) WHERE rn <= {take})"
    )


def rare_tokens(name: str, take: int, cap: int | None = None) -> str:
    long = lambda a: f"list_filter({a}, lambda w: length(w) >= 4)"
    return (
        f"{postings(name + '_f', with_country(long(shortest('name_tokens', 3))), cap, True)},\n{probes(name + '_q', with_country(long('name_tokens')), True)},\n"
        f"{name}_n AS (SELECT key, count(*) AS n FROM {name}_f GROUP BY key),\n"
        f"{name}_r AS (SELECT s1, key, row_number() OVER (PARTITION BY s1 ORDER BY coalesce(n, 0), length(key) DESC, key) AS rk FROM {name}_q LEFT JOIN {name}_n USING (key)),\n"
        f"{name}_p AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ord) AS rn FROM {name}_f),\n"
        f"{name} AS (SELECT s1, cid, ord, 'country_name_token' AS block_type, key AS blocking_key FROM {name}_r JOIN {name}_p USING (key) WHERE rk <= 3 AND rn <= {take})"
    )


def union(name: str, *blocks: str) -> str:
    rows = " UNION ALL ".join(f"SELECT s1, cid, ord, {i} AS prio, block_type, blocking_key FROM {b}" for i, b in enumerate(blocks))
    return first_writer(name, rows)


def first_writer(name: str, rows: str) -> str:
    return (
        f"{name} AS (SELECT s1, cid, ord, prio, block_type, blocking_key FROM (SELECT *, row_number() OVER (PARTITION BY s1, cid ORDER BY prio, block_type, blocking_key) AS k "
        f"FROM ({rows})) WHERE k = 1)"
    )


def late(name: str, found: str, least: int, *ctes: str, last: str, prio: int) -> str:
    """CTE `name`: found, and for reference records of fewer than `least` pairs the block `last` (made from q_few)."""
    few = f"q_few AS (SELECT * FROM q WHERE entity_id NOT IN (SELECT s1 FROM {found} GROUP BY s1 HAVING count(*) >= {least}))"
    rows = f"SELECT * FROM {found} UNION ALL SELECT s1, cid, ord, {prio} AS prio, block_type, blocking_key FROM {last}"
    return ",\n".join([few, *ctes, first_writer(name, rows)])


def fallback(name: str, found: str, take: int, per_country: int, overall: int) -> str:
    h = number("entity_id")
    return (
        f"{name}_a AS (SELECT country_n AS country, ord, entity_id AS cid FROM (SELECT *, row_number() OVER (PARTITION BY country_n ORDER BY ord) AS rn FROM t) WHERE rn <= {per_country} "
        f"UNION ALL SELECT NULL, ord, entity_id FROM (SELECT * FROM t ORDER BY ord LIMIT {overall})),\n"
        f"{name}_p AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY ord) - 1 AS k, count(*) OVER (PARTITION BY country) AS n FROM {name}_a),\n"
        f"{name}_q AS (SELECT entity_id AS s1, country_n, {h} AS h, CASE WHEN country_n IN (SELECT country FROM {name}_p WHERE country IS NOT NULL) THEN country_n END AS want "
        f"FROM q WHERE entity_id NOT IN (SELECT s1 FROM {found})),\n"
        f"{name} AS (SELECT s1, cid, ord, 'fallback' AS block_type, 'fallback:' || CASE WHEN country_n <> '' THEN country_n ELSE 'global' END AS blocking_key "
        f"FROM {name}_q JOIN {name}_p ON want IS NOT DISTINCT FROM country AND (k - h % n + n) % n < least({take}, n))"
    )


def f_beta(p: str, r: str, square: float) -> str:
    return f"CASE WHEN {square} * ({p}) + ({r}) > 0 THEN (1 + {square}) * ({p}) * ({r}) / ({square} * ({p}) + ({r})) ELSE 0.0 END"


def ratio(a: str, b: str, empty: str = "0.0") -> str:
    return f"CASE WHEN ({b}) > 0 THEN ({a}) / CAST({b} AS DOUBLE) ELSE {empty} END"


def entity_f05(tp: str, fp: str, fn: str) -> str:
    return f"CASE WHEN {tp} + {fp} + {fn} = 0 THEN 1.0 ELSE {f_beta(ratio(tp, f'{tp} + {fp}'), ratio(tp, f'{tp} + {fn}'), 0.25)} END"


SETS = """sets AS (
  SELECT l_orderkey AS s1, l_partkey AS id, max(l_returnflag = 'R') AS truth, max(l_linestatus = 'O') AS predicted FROM lineitem GROUP BY ALL)"""
ENTITIES = """ents AS (
  SELECT s1, CAST(count(*) FILTER (WHERE truth AND predicted) AS BIGINT) AS tp, CAST(count(*) FILTER (WHERE NOT truth AND predicted) AS BIGINT) AS fp,
         CAST(count(*) FILTER (WHERE truth AND NOT predicted) AS BIGINT) AS fn FROM sets GROUP BY s1)"""
SCORED = """scored AS (
  SELECT event_id AS pair_id, user_id AS s1, least(value / 400, 1.0) AS probability, CAST(event_type = 'purchase' AS INT) AS label FROM events)"""
