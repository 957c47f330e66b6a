"""SQL pieces shared by the check queries."""

from heronlake.functions.hashing import PRIME, ROUNDS
from heronlake.operators.logs import LINE


def mixed(value: str, seed: int = 0) -> str:
    """SQL of functions.hashing.mixed."""
    x = f"((({value})::BIGINT % {PRIME} + {PRIME}) % {PRIME})"
    for a, b, c in ROUNDS:
        x = f"list_transform([{x}], lambda x: ((x * x) % {PRIME} + x * {a} + {seed % PRIME * b + c}) % {PRIME})[1]"
    return x

LOG_VALUE = """concat('10.0.', CAST(user_id // 256 AS VARCHAR), '.', CAST(user_id % 256 AS VARCHAR),
    ' - u', CAST(user_id AS VARCHAR), ' [', strftime(ts, '%d/%b/%Y:%H:%M:%S'), ' +0000] "GET /', event_type, '/',
    CAST(event_id % 20 AS VARCHAR), ' HTTP/1.1" ',
    CASE event_type WHEN 'error' THEN '500' WHEN 'signup' THEN '201' ELSE '200' END, ' ', {size})"""
SIZE = "CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR)"

RAW_LOG = ("raw_log AS (SELECT event_id, ts, "
           + LOG_VALUE.format(size=f"CASE WHEN event_id % 97 = 0 THEN '-' ELSE {SIZE} END")
           + " AS value FROM events)")
CLEAN_LOG = ("raw_log AS (SELECT event_id, ts, " + LOG_VALUE.format(size=SIZE) + " AS value FROM events)")
PARSED = f"""logs AS (SELECT event_id, ts, regexp_extract(value, '{LINE}', 1) AS ip_address,
    regexp_extract(value, '{LINE}', 2) AS client_identd, regexp_extract(value, '{LINE}', 3) AS user_id,
    regexp_extract(value, '{LINE}', 4) AS date_time, regexp_extract(value, '{LINE}', 5) AS method,
    regexp_extract(value, '{LINE}', 6) AS endpoint, regexp_extract(value, '{LINE}', 7) AS protocol,
    CAST(regexp_extract(value, '{LINE}', 8) AS INTEGER) AS response_code,
    CAST(regexp_extract(value, '{LINE}', 9) AS BIGINT) AS content_size
  FROM raw_log WHERE regexp_matches(value, '{LINE}'))"""
LOGS = f"WITH {RAW_LOG}, {PARSED}"
CLEAN_LOGS = f"WITH {CLEAN_LOG}, {PARSED}"

LINES = """doc_lines AS (SELECT doc_id, i - 1 AS line_no, l[i] AS value FROM (
    SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)))"""


def java_split(col: str) -> str:
    return (f"CASE WHEN length({col}) > 0 AND rtrim({col}, ' ') = '' THEN CAST([] AS VARCHAR[]) "
            f"ELSE string_split(rtrim({col}, ' '), ' ') END")


WORDS = f"{LINES}, words AS (SELECT doc_id, line_no, unnest({java_split('value')}) AS word FROM doc_lines)"

PEOPLE = """people AS (SELECT concat('N', CAST(c_custkey // 10 AS VARCHAR)) AS name,
    CAST(floor(c_acctbal) AS INTEGER) % 100 AS age, c_custkey AS id FROM customer)"""
SALES = """sales AS (SELECT o_orderkey AS txn, l_linenumber AS line, CAST(o_custkey AS VARCHAR) AS customer,
    CAST(l_partkey AS VARCHAR) AS item, l_extendedprice AS value
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
PROJECTS = """projects AS (SELECT s_suppkey AS id, s_name AS name,
    concat('http://site', CAST(s_suppkey AS VARCHAR), '.',
      CASE s_nationkey % 3 WHEN 0 THEN 'org' WHEN 1 THEN 'com' ELSE 'net' END) AS website,
    concat('N', CAST(s_suppkey AS VARCHAR)) AS manager FROM supplier)"""
PLAYS = """plays AS (SELECT CAST(o_custkey AS INTEGER) AS "user", CAST(l_partkey AS INTEGER) AS item,
    CAST(floor(l_quantity) AS INTEGER) AS cnt FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
ARTIST_LINES = """artist_lines AS (SELECT
    CASE WHEN p_partkey % 40 = 7 THEN p_name
         WHEN p_partkey % 40 = 9 THEN concat('x', CAST(p_partkey AS VARCHAR), chr(9), p_name)
         WHEN p_partkey % 40 = 11 THEN concat(CAST(p_partkey AS VARCHAR), chr(9), p_name, chr(9), 'live')
         ELSE concat(CAST(p_partkey AS VARCHAR), chr(9), p_name) END AS value FROM part)"""
ALIAS_LINES = """alias_lines AS (SELECT
    CASE WHEN p_partkey % 100 = 0 THEN concat(chr(9), CAST(p_partkey AS VARCHAR))
         ELSE concat(CAST(p_partkey AS VARCHAR), chr(9), CAST(p_partkey - 1 AS VARCHAR)) END AS value
    FROM part WHERE p_partkey % 25 = 0)"""
STATUS = """status AS (SELECT event_id AS id, ts AS created_at,
    CASE user_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' WHEN 2 THEN 'de' ELSE 'es' END AS lang,
    concat('u', CAST(user_id AS VARCHAR)) AS name,
    concat('user ', CAST(user_id AS VARCHAR), ' #', event_type, ' #t', CAST(event_id % 13 AS VARCHAR),
      CASE WHEN event_id % 7 = 0 THEN ' plain#notag' ELSE '' END) AS text FROM events)"""
TAGS = f"""{STATUS}, tags AS (SELECT id, ts, tag FROM (
    SELECT id, created_at AS ts, unnest(string_split(text, ' ')) AS tag FROM status) WHERE starts_with(tag, '#'))"""
MESSAGES = """messages AS (SELECT 'log' AS topic, event_id % 4 AS part, event_id // 4 AS offs, ts, event_id,
    concat(event_type, ' ', CAST(user_id % 10 AS VARCHAR), ' ', CAST(event_id % 10 AS VARCHAR)) AS value
    FROM events)"""
MESSAGE_WORDS = (f"{MESSAGES}, words AS (SELECT event_id, topic, part, offs, ts, "
                 f"unnest({java_split('value')}) AS word FROM messages)")
LEXICON = """lexicon(word, score) AS (VALUES ('click', 2), ('view', 1), ('purchase', 3), ('signup', 2), ('error', -3))"""
BLACKLIST = "blacklist(word) AS (VALUES ('the'), ('of'), ('and'), ('a'))"
