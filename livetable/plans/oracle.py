"""DuckDB SQL for each query key, written independently of the Spark code:
the same result computed the plain way (brute force where that is simpler).

Views available: region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations.
"""

from __future__ import annotations

from livetable.functions.text import NON_BLANK_PATTERN

# Documents cut into lines, then words with the single-blank split rule.
_LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS value FROM documents"
_WORDS = f"""
SELECT doc_id, unnest(CASE WHEN value = '' THEN ['']
                           WHEN rtrim(value, ' ') = '' THEN []::VARCHAR[]
                           ELSE string_split(rtrim(value, ' '), ' ') END) AS word
FROM ({_LINES})"""

_IOT = """
SELECT 'device_' || CAST(event_id AS VARCHAR) AS device_id, event_type AS deviceType,
       value AS signal, epoch_us(ts) // 1000 AS time
FROM events"""

_ANSWERS = """
SELECT '学生ID_' || CAST(o.o_custkey AS VARCHAR) AS student_id,
       '教材ID_' || p.p_type AS textbook_id,
       '年级ID_' || substr(o.o_orderpriority, 1, 1) AS grade_id,
       '科目ID_' || p.p_brand AS subject_id,
       '章节ID_chapter_' || CAST(l.l_linenumber AS VARCHAR) AS chapter_id,
       '题目ID_' || CAST(l.l_partkey AS VARCHAR) AS question_id,
       CAST(floor(l.l_quantity) AS INTEGER) % 11 AS score,
       strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS answer_time,
       o.o_orderdate AS ts
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                JOIN part p ON l.l_partkey = p.p_partkey"""

_RATINGS = f"""
SELECT CAST(split_part(student_id, '_', 2) AS BIGINT) AS student_id,
       CAST(split_part(question_id, '_', 2) AS BIGINT) AS question_id,
       CAST(CASE WHEN score <= 3 THEN 3 WHEN score <= 8 THEN 2 ELSE 1 END AS FLOAT) AS rating
FROM ({_ANSWERS}) WHERE score IS NOT NULL"""

# Ratings with the bucket (of ten) of their hash split.
_SPLIT = f"""s AS (
    SELECT *, ('0x' || substr(md5(concat_ws(':', '11', CAST(student_id AS VARCHAR),
                                            CAST(question_id AS VARCHAR))), 1, 8))::BIGINT % 10 AS bucket
    FROM ({_RATINGS}))"""

_EVENT_WORDS = """
SELECT CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS timestamp, event_type AS word
FROM events"""

_SLIDING = f"""
WITH b AS (SELECT word, time_bucket(INTERVAL 30 MINUTE, timestamp) AS s FROM ({_EVENT_WORDS})),
w AS (SELECT word, s AS window_start FROM b
      UNION ALL SELECT word, s - INTERVAL 30 MINUTE FROM b)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, word, count(*) AS "count"
FROM w GROUP BY window_start, word"""

_RECS_TEXT = """
WITH per AS (SELECT o.o_custkey AS s, l.l_partkey AS q, sum(l.l_quantity) AS tot
             FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2),
r AS (SELECT s, q, row_number() OVER (PARTITION BY s ORDER BY tot DESC, q) AS rk FROM per)
SELECT '学生ID_' || CAST(s AS VARCHAR) AS student_id,
       string_agg('题目ID_' || CAST(q AS VARCHAR), ',' ORDER BY rk) AS recommendations
FROM r WHERE rk <= 3 GROUP BY s"""

ORACLE: dict[str, str] = {
    "wordcount_dsl": f'SELECT word, count(*) AS "count" FROM ({_WORDS}) GROUP BY word',
    "wordcount_sql": f"SELECT word AS value, count(*) AS counts FROM ({_WORDS}) GROUP BY word",
    "wordcount_stream_memory": """
        WITH l AS (SELECT lang, unnest(string_split(text, chr(10))) AS value FROM documents),
        w AS (SELECT lang, unnest(CASE WHEN value = '' THEN ['']
                                       WHEN rtrim(value, ' ') = '' THEN []::VARCHAR[]
                                       ELSE string_split(rtrim(value, ' '), ' ') END) AS word FROM l)
        SELECT lang, count(*) AS "count" FROM w GROUP BY lang""",
    "foreach_batch_second_output": f"""
        SELECT "count", count(*) AS words
        FROM (SELECT word, count(*) AS "count" FROM ({_WORDS}) GROUP BY word) GROUP BY 1""",
    "foreach_batch_snapshot": f'SELECT word, count(*) AS "count" FROM ({_WORDS}) GROUP BY word',
    "split_words_append": f"SELECT doc_id, word FROM ({_WORDS})",
    "nonblank_filter": f"""
        SELECT doc_id, value FROM (
          SELECT doc_id, unnest(string_split(text, '.')) AS value FROM documents)
        WHERE regexp_matches(value, '{NON_BLANK_PATTERN}')""",
    "json_extract_fields": _IOT,
    "iot_stats_sql": f"""
        SELECT deviceType, count(*) AS counts, round(avg(signal), 6) AS mean_signal
        FROM ({_IOT}) WHERE signal > 30 GROUP BY deviceType""",
    "iot_stats_dsl": f"""
        SELECT deviceType, count(device_id) AS counts, round(avg(signal), 6) AS mean_signal
        FROM ({_IOT}) WHERE signal > 30 GROUP BY deviceType""",
    "etl_contains_filter": """
        SELECT value FROM (
          SELECT concat_ws(',', 'station_' || CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR),
                           event_type, strftime(ts, '%Y-%m-%d %H:%M:%S')) AS value
          FROM events) WHERE contains(value, 'error')""",
    "event_line_parse": _EVENT_WORDS,
    "json_struct_parse": _ANSWERS,
    "json_lines_batch_read": _ANSWERS,
    "delimited_stream_read": "SELECT * FROM customer",
    "top10_questions": f'''
        SELECT question_id, count(*) AS "count" FROM ({_ANSWERS})
        GROUP BY question_id ORDER BY "count" DESC, question_id LIMIT 10''',
    "top10_grades": f'''
        SELECT grade_id, count(*) AS "count" FROM ({_ANSWERS})
        GROUP BY grade_id ORDER BY "count" DESC, grade_id LIMIT 10''',
    "top10_questions_with_subject": f'''
        SELECT question_id, min(subject_id) AS subject_id, count(question_id) AS "count"
        FROM ({_ANSWERS}) GROUP BY question_id ORDER BY "count" DESC, question_id LIMIT 10''',
    "lowest_score_students": f"""
        WITH r AS (SELECT student_id, score, question_id,
                          row_number() OVER (PARTITION BY student_id ORDER BY score, question_id) AS rn
                   FROM ({_ANSWERS}) WHERE score IS NOT NULL)
        SELECT student_id, score AS minscore, question_id FROM r WHERE rn = 1
        ORDER BY minscore, student_id LIMIT 10""",
    "lowest_questions_per_student": f"""
        WITH m AS (SELECT student_id, question_id, min(score) AS score FROM ({_ANSWERS})
                   WHERE score IS NOT NULL GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY student_id ORDER BY score, question_id) AS rank FROM m)
        SELECT student_id, question_id, score, rank FROM r WHERE rank <= 10""",
    "top10_questions_stream": f'''
        SELECT question_id, count(*) AS "count" FROM ({_ANSWERS})
        GROUP BY question_id ORDER BY "count" DESC, question_id LIMIT 10''',
    "window_sliding_complete": _SLIDING,
    "window_sliding_update": _SLIDING,
    "window_sliding_append": f"""
        SELECT * FROM ({_SLIDING})
        WHERE window_end <= (SELECT date_trunc('millisecond', max(timestamp)) - INTERVAL 10 MINUTE
                             FROM ({_EVENT_WORDS}))""",
    "window_tumbling_daily": f'''
        SELECT date_trunc('day', timestamp) AS window_start,
               date_trunc('day', timestamp) + INTERVAL 1 DAY AS window_end, word, count(*) AS "count"
        FROM ({_EVENT_WORDS}) GROUP BY 1, 2, 3''',
    "window_tumbling_daily_stream": f'''
        SELECT date_trunc('day', timestamp) AS window_start,
               date_trunc('day', timestamp) + INTERVAL 1 DAY AS window_end, word, count(*) AS "count"
        FROM ({_EVENT_WORDS}) GROUP BY 1, 2, 3''',
    "dedup_user_counts": '''
        SELECT userID, count(*) AS "count" FROM (
          SELECT DISTINCT CAST(user_id AS VARCHAR) AS userID, strftime(ts, '%Y-%m-%d') AS d, event_type
          FROM events) GROUP BY userID''',
    "dedup_user_counts_staged": '''
        SELECT userID, count(*) AS "count" FROM (
          SELECT DISTINCT CAST(user_id AS VARCHAR) AS userID, strftime(ts, '%Y-%m-%d') AS d, event_type
          FROM events) GROUP BY userID''',
    "dedup_within_watermark": """
        SELECT DISTINCT CAST(user_id AS VARCHAR) AS userID, strftime(ts, '%Y-%m-%d %H:00:00') AS eventTime,
               event_type AS eventType FROM events""",
    "id_to_number": f"""
        SELECT student_id, TRY_CAST(split_part(student_id, '_', 2) AS INTEGER) AS student_num,
               question_id, TRY_CAST(split_part(question_id, '_', 2) AS INTEGER) AS question_num
        FROM ({_ANSWERS})""",
    "rating_bucket": f"""
        SELECT score, CAST(CASE WHEN score <= 3 THEN 3 WHEN score <= 8 THEN 2 ELSE 1 END AS FLOAT) AS rating,
               count(*) AS n
        FROM ({_ANSWERS}) WHERE score IS NOT NULL GROUP BY score""",
    "ratings_extract": _RATINGS,
    "rmse_aggregate": f"""
        WITH r AS ({_RATINGS}),
        m AS (SELECT question_id, avg(rating) AS mu FROM r GROUP BY question_id)
        SELECT round(sqrt(avg(pow(r.rating - m.mu, 2))), 6) AS rmse, count(*) AS n
        FROM r JOIN m USING (question_id)""",
    "hash_split_counts": f"""
        SELECT CASE WHEN ('0x' || substr(md5(concat_ws(':', '11', CAST(student_id AS VARCHAR),
                                                        CAST(question_id AS VARCHAR))), 1, 8))::BIGINT % 10 < 8
                    THEN 'train' ELSE 'test' END AS split,
               count(*) AS n
        FROM ({_RATINGS}) GROUP BY 1""",
    "recs_to_string": _RECS_TEXT,
    "answers_join_recs": f"SELECT * FROM ({_ANSWERS}) a JOIN ({_RECS_TEXT}) r USING (student_id)",
    "stream_static_join": f"SELECT * FROM ({_ANSWERS}) a JOIN ({_RECS_TEXT}) r USING (student_id)",
    "registry_latest": """
        WITH reg AS (SELECT 'model_' || o_orderstatus AS model, o_orderpriority AS item,
                            'models/' || CAST(o_orderkey AS VARCHAR) AS path,
                            o_totalprice AS rmse, o_orderdate AS created_at FROM orders),
        r AS (SELECT *, row_number() OVER (PARTITION BY model, item
                                           ORDER BY created_at DESC, path DESC) AS rn FROM reg)
        SELECT model, item, path, created_at, rmse FROM r WHERE rn = 1""",
    "missing_id_xor": """
        WITH p AS (SELECT DISTINCT doc_id AS id FROM labels WHERE doc_id IS NOT NULL),
        b AS (SELECT min(id) AS lo, max(id) AS hi, count(*) AS n FROM p),
        m AS (SELECT unnest(generate_series(lo, hi)) AS id FROM b EXCEPT SELECT id FROM p)
        SELECT lo, hi, hi - lo + 1 - n AS n_missing,
               (SELECT coalesce(bit_xor(id), 0) FROM m) AS xor_missing,
               CASE WHEN hi - lo + 1 - n = 1 THEN (SELECT max(id) FROM m) END AS missing_id
        FROM b""",
    "missing_ids_anti": """
        WITH b AS (SELECT min(doc_id) AS lo, max(doc_id) AS hi FROM labels)
        SELECT unnest(generate_series(lo, hi)) AS missing_id FROM b
        EXCEPT ALL SELECT doc_id FROM labels""",
    "event_line_quarantine": """
        SELECT substr(strftime(ts, '%Y-%m-%d %H:%M:%S') || ',' || event_type, 1, 12) AS value
        FROM events WHERE event_id % 5 = 0""",
    "json_quarantine": """
        SELECT substr('{"device":"device_' || CAST(event_id AS VARCHAR), 1, 12) AS value
        FROM events WHERE event_id % 5 = 0""",
    "rmse_predictions": f"""
        SELECT round(sqrt(avg(pow(rating - (3.0 - score / 5.0), 2))), 6) AS rmse, count(*) AS n
        FROM (SELECT score, CAST(CASE WHEN score <= 3 THEN 3 WHEN score <= 8 THEN 2 ELSE 1 END AS DOUBLE) AS rating
              FROM ({_ANSWERS})) WHERE score IS NOT NULL""",
    "serve_batches": f"SELECT * FROM ({_ANSWERS}) a JOIN ({_RECS_TEXT}) r USING (student_id)",
    # Each answer of a student that its version's training split knows, with that version.
    "serve_published": f"""
        WITH a AS (SELECT *, CASE WHEN ts < TIMESTAMP '1998-06-01 00:00:00' THEN 1 ELSE 2 END AS half FROM ({_ANSWERS})),
        s AS (SELECT student_id, question_id, half FROM a WHERE score IS NOT NULL AND
                ('0x' || substr(md5(concat_ws(':', '11', split_part(student_id, '_', 2),
                                              split_part(question_id, '_', 2))), 1, 8))::BIGINT % 10 < 8),
        k AS (SELECT DISTINCT v.version, student_id FROM s JOIN (VALUES (1), (2)) v(version) ON half <= v.version),
        q AS (SELECT v.version, least(10, count(DISTINCT question_id)) AS n FROM s JOIN (VALUES (1), (2)) v(version)
                ON half <= v.version GROUP BY v.version)
        SELECT a.student_id, question_id, answer_time, score, CAST(half AS BIGINT) AS model_version, CAST(n AS BIGINT) AS n_recs
        FROM a JOIN k ON k.version = half AND k.student_id = a.student_id JOIN q ON q.version = half""",
    "als_predict": f"""
        WITH {_SPLIT}
        SELECT student_id, question_id, rating, TRUE AS scored FROM s
        WHERE bucket >= 8 AND student_id IN (SELECT student_id FROM s WHERE bucket < 8)
          AND question_id IN (SELECT question_id FROM s WHERE bucket < 8)""",
    "als_recommend_all": f"""
        WITH {_SPLIT}, q AS (SELECT count(DISTINCT question_id) AS questions FROM s WHERE bucket < 8)
        SELECT DISTINCT student_id, least(20, questions) AS n, TRUE AS descending, TRUE AS distinct_items
        FROM s, q WHERE bucket < 8""",
    "als_recommend_subset": f"""
        WITH {_SPLIT}, q AS (SELECT count(DISTINCT question_id) AS questions FROM s WHERE bucket < 8),
        a AS (SELECT CAST(split_part(student_id, '_', 2) AS BIGINT) AS student_id, CAST(ts AS DATE) AS day FROM ({_ANSWERS}))
        SELECT DISTINCT student_id, least(10, questions) AS n, TRUE AS descending, TRUE AS distinct_items
        FROM a, q WHERE day = (SELECT max(day) FROM a) AND student_id IN (SELECT student_id FROM s WHERE bucket < 8)""",
    "topic_replay": """
        SELECT CAST(event_id % 4 AS INTEGER) AS partition, event_id AS "offset",
               concat_ws(',', 'station_' || CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR), event_type,
                         strftime(ts, '%Y-%m-%d %H:%M:%S')) AS value, ts AS timestamp
        FROM events""",
    "two_phase_sink": "SELECT event_id, user_id, event_type, value FROM events",
    "windows_with_late_rows": """
        WITH e AS (SELECT ts, event_type, date_trunc('hour', ts) AS window_start, event_id % 50 = 7 AS delayed FROM events),
        marks AS (SELECT max(ts) FILTER (WHERE NOT delayed) - INTERVAL 10 MINUTE AS before_last,
                         max(ts) - INTERVAL 10 MINUTE AS at_end FROM e),
        judged AS (SELECT *, delayed AND window_start + INTERVAL 1 HOUR <= before_last AS late,
                          window_start + INTERVAL 1 HOUR <= at_end AS closed FROM e, marks)
        SELECT CASE WHEN late THEN 'late' WHEN closed THEN 'final' ELSE 'open' END AS kind, window_start, event_type,
               count(*) AS "count"
        FROM judged GROUP BY ALL""",
    "als_topk_exact": f"""
        WITH {_SPLIT}, q AS (SELECT count(DISTINCT question_id) AS questions FROM s WHERE bucket < 8)
        SELECT DISTINCT student_id, least(20, questions) AS n, TRUE AS descending, TRUE AS distinct_items, TRUE AS products_match
        FROM s, q WHERE bucket < 8""",
}
ORACLE["missing_ids_ranges"] = ORACLE["missing_ids_anti"]
ORACLE["wordcount_state"] = ORACLE["wordcount_dsl"]
for _live in ("top10_questions", "top10_grades", "top10_questions_with_subject", "lowest_score_students"):
    ORACLE[f"{_live}_stream"] = ORACLE[_live]
ORACLE["iot_stats_stream"] = ORACLE["iot_stats_dsl"]
