"""The queries again as SQL for DuckDB, to check results against.

``train_predict`` and ``end_to_end_run`` give what a trained model predicts and have none. That the
model is the optimum is checked by ``train_class_mass`` and ``train_gradient``: a solver with other
settings misses them. The two queries on reloaded models tell whether they predict the same.
"""

from __future__ import annotations

from textpipe.functions.stopwords import ENGLISH
from textpipe.functions.text import NA_TOKENS, TOKEN_PATTERN, WHITESPACE
from textpipe.plans.queries import LANGUAGE_LABEL, MAX_FEATURES, RULE

_STOP = ", ".join(f"'{word}'" for word in ENGLISH)
_TOKENS = f"regexp_extract_all(lower(text), '{TOKEN_PATTERN}')"

_BASE = f"base AS (SELECT doc_id, text, {LANGUAGE_LABEL} AS label FROM documents)"

_ALLOCATION = f"""{_BASE},
classes AS (SELECT label, CAST(count(*) AS BIGINT) AS n_rows FROM base GROUP BY label),
total AS (SELECT CAST(sum(n_rows) AS BIGINT) AS n,
                 CAST(sum(n_rows) - ceil(CAST(0.2 AS DOUBLE) * sum(n_rows)) AS BIGINT) AS n_train
          FROM classes),
shares AS (SELECT label, n_rows, n_rows * n_train // n AS whole, n_rows * n_train % n AS rest, n_train
           FROM classes CROSS JOIN total),
ranked AS (SELECT *, row_number() OVER (ORDER BY rest DESC, label) AS place,
                  n_train - sum(whole) OVER () AS missing FROM shares),
allocation AS (SELECT label, n_rows,
                      CAST(whole + CASE WHEN place <= missing THEN 1 ELSE 0 END AS BIGINT) AS n_train
               FROM ranked)"""

_SPLIT = f"""{_ALLOCATION},
ordered AS (SELECT doc_id, text, label,
                   row_number() OVER (PARTITION BY label
                       ORDER BY md5(concat('42:', CAST(doc_id AS VARCHAR))), doc_id) AS place
            FROM base),
sides AS (SELECT o.doc_id, o.text, o.label,
                 CASE WHEN o.place <= a.n_train THEN 'train' ELSE 'test' END AS split
          FROM ordered o JOIN allocation a ON o.label = a.label)"""

_TERMS = f"""{_SPLIT},
words AS (SELECT doc_id, split, unnest({_TOKENS}) AS term FROM sides),
tf AS (SELECT doc_id, split, term, CAST(count(*) AS BIGINT) AS tf FROM words
       WHERE term NOT IN ({_STOP}) GROUP BY doc_id, split, term),
stats AS (SELECT term, CAST(sum(tf) AS BIGINT) AS corpus_tf, CAST(count(*) AS BIGINT) AS df
          FROM tf WHERE split = 'train' GROUP BY term),
top AS (SELECT * FROM stats ORDER BY corpus_tf DESC, term LIMIT {MAX_FEATURES}),
vocabulary AS (SELECT *, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx FROM top),
weighted AS (SELECT *, ln((1.0 + (SELECT count(*) FROM sides WHERE split = 'train'))
                          / (1.0 + df)) + 1.0 AS idf FROM vocabulary)"""


def _tfidf(split: str) -> str:
    return f"""WITH {_TERMS},
entries AS (SELECT tf.doc_id, tf.term, w.idx, tf.tf * w.idf AS weight
            FROM tf JOIN weighted w ON tf.term = w.term WHERE tf.split = '{split}')
SELECT doc_id, term, idx,
       round(weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)), 6) AS tfidf
FROM entries"""


_RULED = f"""ruled AS (SELECT d.doc_id, l.quality AS label, {RULE} AS prediction
FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

_REPORT = f"""{_RULED},
known AS (SELECT label FROM ruled UNION SELECT prediction FROM ruled),
per_label AS (SELECT k.label,
    (SELECT count(*) FROM ruled r WHERE r.label = k.label AND r.prediction = k.label) AS hits,
    (SELECT count(*) FROM ruled r WHERE r.prediction = k.label) AS predicted,
    (SELECT count(*) FROM ruled r WHERE r.label = k.label) AS support FROM known k),
per_class AS (SELECT label, hits, support,
    CASE WHEN predicted = 0 THEN 0.0e0 ELSE hits / predicted END AS pr,
    CASE WHEN support = 0 THEN 0.0e0 ELSE hits / support END AS re,
    CASE WHEN predicted + support = 0 THEN 0.0e0 ELSE 2.0e0 * hits / (predicted + support) END AS f1
    FROM per_label),
report AS (
    SELECT 0 AS place, label, CAST(label AS VARCHAR) AS row_name, pr AS "precision", re AS recall,
           f1 AS f1_score, support FROM per_class
    UNION ALL
    SELECT 1, NULL, 'accuracy', NULL, NULL, sum(hits) / sum(support), sum(support) FROM per_class
    UNION ALL
    SELECT 2, NULL, 'macro avg', avg(pr), avg(re), avg(f1), sum(support) FROM per_class
    UNION ALL
    SELECT 3, NULL, 'weighted avg', sum(pr * support) / sum(support),
           sum(re * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
    FROM per_class)"""

_SAME_PREDICTIONS = f"""WITH {_SPLIT}
SELECT doc_id, label, TRUE AS same_prediction FROM sides WHERE split = 'test'"""

_NA_CELLS = f"WHEN source = 'src{len(NA_TOKENS)}' THEN md5('   ')"

ORACLE: dict[str, str] = {
    "corpus_scan": f"""SELECT doc_id, md5(text) AS text_md5, CAST(length(text) AS INTEGER) AS length,
        {LANGUAGE_LABEL} AS label FROM documents""",
    "csv_round_trip": f"""SELECT doc_id, md5(text) AS text_md5, {LANGUAGE_LABEL} AS label
        FROM documents""",
    "csv_scan_na_tokens": f"""SELECT doc_id, CASE WHEN lang = 'en' THEN md5(text) {_NA_CELLS} END
        AS text_md5, {LANGUAGE_LABEL} AS label FROM documents""",
    "split_write_read": f"""WITH {_SPLIT}
        SELECT doc_id, label, split, md5(text) AS text_md5 FROM sides""",
    "vectorizer_reload_tfidf": _tfidf("test"),
    "metrics_report_text": f"""WITH {_REPORT},
        lines AS (SELECT place, label, printf('%12s  %9s %9s %9s %9s', row_name,
            CASE WHEN "precision" IS NULL THEN '' ELSE printf('%.2f', "precision") END,
            CASE WHEN recall IS NULL THEN '' ELSE printf('%.2f', recall) END,
            printf('%.2f', f1_score), CAST(support AS VARCHAR)) || chr(10) AS line FROM report)
        SELECT printf('Accuracy: %.4f', (SELECT f1_score FROM report WHERE place = 1))
            || chr(10) || chr(10) || 'Classification Report:' || chr(10)
            || printf('%12s  %9s %9s %9s %9s', '', 'precision', 'recall', 'f1-score', 'support')
            || chr(10) || chr(10)
            || (SELECT string_agg(line, '' ORDER BY label) FROM lines WHERE place = 0) || chr(10)
            || (SELECT string_agg(line, '' ORDER BY place) FROM lines WHERE place > 0) AS report""",
    "project_text_label": f"SELECT text, {LANGUAGE_LABEL} AS label FROM documents",
    "label_name_map": f"""SELECT doc_id, label, CASE label WHEN 0 THEN 'World' WHEN 1 THEN 'Sports'
            WHEN 2 THEN 'Business' WHEN 3 THEN 'Sci/Tech' END AS label_name
        FROM (SELECT doc_id, {LANGUAGE_LABEL} + CASE WHEN source = 'src0' THEN 4 ELSE 0 END AS label
              FROM documents)""",
    "tokenize": f"""SELECT doc_id, CAST(len(words) AS BIGINT) AS n_tokens,
            md5(array_to_string(words, ' ')) AS tokens_md5
        FROM (SELECT doc_id, {_TOKENS} AS words FROM documents)""",
    "stop_word_removal": f"""WITH words AS (SELECT doc_id, unnest({_TOKENS}) AS term,
            generate_subscripts({_TOKENS}, 1) AS place FROM documents),
        kept AS (SELECT doc_id, count(*) AS n, string_agg(term, ' ' ORDER BY place) AS joined
            FROM words WHERE term NOT IN ({_STOP}) GROUP BY doc_id)
        SELECT d.doc_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_kept,
               md5(coalesce(k.joined, '')) AS kept_md5
        FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id""",
    "validate_table": """SELECT 'valid' AS name, CASE WHEN count(*) >= 100 THEN 'ok' END AS outcome
            FROM documents
        UNION ALL SELECT 'too few rows', 'DataFrame has ' || CAST(count(*) AS VARCHAR)
            || ' rows, minimum required: 1000000000000' FROM documents
        UNION ALL SELECT 'missing columns', 'Missing required columns: [''topic'', ''title'']'
        UNION ALL SELECT 'empty', 'DataFrame is empty'""",
    "failure_cases": """SELECT * FROM (VALUES
        ('no such file', 'FileNotFoundError', 'File not found: /no_such_table.parquet'),
        ('no such model', 'FileNotFoundError', 'File not found: /no_such_run/models/classifier'),
        ('empty table', 'ValueError', 'DataFrame is empty'),
        ('small class', 'ValueError', 'Classes with fewer than 2 rows cannot be stratified: [0]'),
        ('null labels', 'ValueError', 'Null labels cannot be stratified'),
        ('repeated keys', 'RepeatedKeys',
            'Column doc_id repeats its values; the split needs one key per row'),
        ('null text', 'ValueError', 'Null documents in text column cannot be vectorized'),
        ('no terms', 'ValueError',
            'Empty vocabulary: the documents hold only stop words or no tokens'),
        ('nothing to train on', 'ValueError', 'Cannot train on an empty table'),
        ('training null labels', 'ValueError', 'Cannot train with null labels'),
        ('training one class', 'ValueError', 'Cannot train with a single class')
        ) AS cases(case_name, error, message)
        WHERE (SELECT count(*) FROM documents) > 0""",
    "json_round_trip": f"""SELECT doc_id, md5(text) AS text_md5, {LANGUAGE_LABEL} AS label
        FROM documents""",
    "text_quality": f"""SELECT CAST(count(*) AS BIGINT) AS n_rows,
            CAST(count(*) FILTER (body IS NULL) AS BIGINT) AS n_null,
            CAST(count(*) FILTER (regexp_full_match(body, '{WHITESPACE}*')) AS BIGINT) AS n_blank
        FROM (SELECT CASE WHEN n_chars < 60 THEN NULL
            WHEN n_chars < 200 THEN chr(160) || ' ' || chr(9) || chr(8195) || chr(28)
            ELSE text END AS body FROM documents)""",
    "row_counts": f"""WITH {_SPLIT}
        SELECT split AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM sides GROUP BY split
        UNION ALL SELECT 'corpus', CAST(count(*) AS BIGINT) FROM sides""",
    "class_counts": f"""SELECT {LANGUAGE_LABEL} AS label, CAST(count(*) AS BIGINT) AS n_rows
        FROM documents GROUP BY 1""",
    "split_allocation": f"""WITH {_ALLOCATION}
        SELECT label, n_rows, n_train, n_rows - n_train AS n_test FROM allocation""",
    "stratified_split": f"WITH {_SPLIT} SELECT doc_id, label, split FROM sides",
    "split_is_partition": f"""WITH {_SPLIT}
        SELECT split AS part, CAST(count(*) AS BIGINT) AS n_rows FROM sides GROUP BY split
        UNION ALL SELECT 'missing', CAST(0 AS BIGINT) UNION ALL SELECT 'added', CAST(0 AS BIGINT)""",
    "term_frequency": f"""SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf
        FROM (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents)
        WHERE term NOT IN ({_STOP}) GROUP BY doc_id, term""",
    "corpus_term_count": f"WITH {_TERMS} SELECT term, corpus_tf FROM stats",
    "document_frequency": f"WITH {_TERMS} SELECT term, df FROM stats",
    "vocabulary_topk": f"WITH {_TERMS} SELECT term, corpus_tf FROM top",
    "vocabulary_sketch": f"""WITH {_TERMS}
        SELECT term, corpus_tf, df FROM stats ORDER BY corpus_tf DESC, term LIMIT 500""",
    "resumed_stages": """SELECT change, stage, place >= first_place AS reran
        FROM (VALUES ('nothing', 9), ('max_iter', 4), ('max_features', 3), ('seed', 2)) AS c(change, first_place),
            (VALUES ('land', 1), ('prepare', 2), ('featurize', 3), ('train', 4), ('evaluate', 5)) AS s(stage, place)
        WHERE (SELECT count(*) FROM documents) > 0""",
    "former_run_kept": f"WITH {_SPLIT} SELECT doc_id, label, split FROM sides",
    "vocabulary_index": f"WITH {_TERMS} SELECT term, idx FROM vocabulary",
    "vocab_join_oov_drop": f"""WITH {_TERMS} SELECT tf.doc_id, tf.term, v.idx, tf.tf
        FROM tf JOIN vocabulary v ON tf.term = v.term WHERE tf.split = 'test'""",
    "idf_weights": f"WITH {_TERMS} SELECT term, idx, df, round(idf, 6) AS idf FROM weighted",
    "tfidf_train": _tfidf("train"),
    "tfidf_test": _tfidf("test"),
    "feature_shape": f"""WITH {_TERMS}
        SELECT split, CAST(count(*) AS BIGINT) AS n_rows,
               CAST((SELECT count(*) FROM vocabulary) AS BIGINT) AS n_features
        FROM sides GROUP BY split""",
    "confusion_counts": f"""WITH {_RULED} SELECT label, prediction, CAST(count(*) AS BIGINT) AS n_rows
        FROM ruled GROUP BY label, prediction""",
    "report_label_set": f"""WITH {_RULED}
        SELECT label FROM ruled UNION SELECT prediction AS label FROM ruled""",
    "accuracy": f"""WITH {_RULED} SELECT round(avg(CASE WHEN label = prediction THEN 1.0e0
        ELSE 0.0e0 END), 6) AS accuracy FROM ruled""",
    "class_report": f"""WITH {_REPORT} SELECT row_name, round("precision", 6) AS "precision",
        round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
        CAST(support AS BIGINT) AS support FROM report""",
    "predicted_rows": f"""WITH {_SPLIT}
        SELECT doc_id, label, TRUE AS known_label, TRUE AS largest_margin FROM sides WHERE split = 'test'""",
    "train_class_mass": f"WITH {_ALLOCATION} SELECT label, n_train FROM allocation",
    "train_gradient": f"""WITH {_TERMS}
        SELECT label, idx, CAST(0 AS DOUBLE) AS gradient FROM vocabulary CROSS JOIN classes""",
    "pipeline_end_to_end": f"""WITH {_ALLOCATION}
        SELECT CAST(label AS VARCHAR) AS row_name, n_rows - n_train AS support, TRUE AS consistent
        FROM allocation
        UNION ALL SELECT row_name, (SELECT CAST(sum(n_rows - n_train) AS BIGINT) FROM allocation), TRUE
        FROM (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) AS totals(row_name)""",
    "run_summary": """SELECT 'success' AS status, 'metrics.txt' AS metrics_name,
        TRUE AS accuracy_is_stored FROM documents LIMIT 1""",
    "model_reload_predict": _SAME_PREDICTIONS,
    "score_from_artifacts": _SAME_PREDICTIONS,
}
