"""DuckDB SQL for every registered query, written independently of the Spark code.

The statements share common table expressions; ``_with`` puts the needed ones in
front of a query, in the order of ``PARTS``.
"""

from __future__ import annotations

import re

from gleanery.functions.text import CONTRACTIONS, PUNCTUATION, QUOTES, STOP_WORDS, WHITE_SPACE
from gleanery.operators.cleaning import NOUN_ENDINGS
from gleanery.operators.prompts import INSTRUCTIONS, NO_CONTENT, NOTHING_FOUND


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_SPACE = _text(WHITE_SPACE)
_PUNCT = _text(PUNCTUATION)
_STOP = "[" + ", ".join(_text(w) for w in STOP_WORDS) + "]"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), {_SPACE}), lambda w: w <> '')"


def _normal(text: str) -> str:
    plain = f"translate(lower(coalesce({text}, '')), {_PUNCT}, '')"
    return rf"regexp_replace({plain}, '\p{{Nd}}+', '', 'g')"


def _tokens(text: str) -> str:
    out = rf"regexp_replace({_normal(text)}, '([{QUOTES}])', ' \1 ', 'g')"
    for pair in CONTRACTIONS:
        head, tail = pair.split()
        out = rf"regexp_replace({out}, '\b({head})({tail})\b', ' \1 \2 ', 'g')"
    return _words(out)


def _content(text: str) -> str:
    return f"list_filter({_tokens(text)}, lambda w: NOT list_contains({_STOP}, w))"


def _snippet(text: str) -> str:
    text = f"coalesce({text}, '')"
    return f"CASE WHEN length({text}) > 150 THEN left({text}, 150) || '...' ELSE {text} END"


def _score(value: str) -> str:
    return f"round({value}, 6) + 0.0"


PARTS: dict[str, str] = {}

PARTS["doc_words"] = f"""
SELECT doc_id, unnest({_content('text')}) AS word FROM documents"""

PARTS["vocab"] = """
SELECT word, count(DISTINCT doc_id) AS n_docs FROM doc_words GROUP BY word"""

PARTS["lemma_candidates"] = " UNION ALL ".join(
    f"""
SELECT word, n_docs, left(word, length(word) - {len(end)}) || '{one}' AS lemma
FROM vocab WHERE suffix(word, '{end}') AND NOT regexp_matches(word, '(ss|us|is)$')"""
    for end, one in NOUN_ENDINGS.items()
)

PARTS["lemmas"] = """
SELECT word, lemma, n_docs FROM (
  SELECT c.*, row_number() OVER (PARTITION BY c.word ORDER BY length(c.lemma), c.lemma) AS pick
  FROM lemma_candidates c JOIN vocab v ON v.word = c.lemma AND v.n_docs * 50 >= c.n_docs
) WHERE pick = 1"""

PARTS["bag"] = """
SELECT d.doc_id, coalesce(l.lemma, d.word) AS term, count(*) AS tf
FROM doc_words d LEFT JOIN lemmas l ON l.word = d.word GROUP BY ALL"""

PARTS["stats"] = """
SELECT term, count(*) AS df,
       ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))::DOUBLE) + 1 AS idf
FROM bag GROUP BY term"""

PARTS["raw_weights"] = """
SELECT b.doc_id, b.term, b.tf * s.idf AS weight FROM bag b JOIN stats s ON s.term = b.term"""

PARTS["doc_weights"] = """
SELECT doc_id, term, weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS weight
FROM raw_weights"""

# Queries: all benchmark texts, and the part names.
PARTS["asked"] = "SELECT item_id AS query_id, text AS query FROM benchmark"
PARTS["asked_parts"] = "SELECT p_partkey AS query_id, p_name AS query FROM part"


def _clean_words(name: str, source: str, key: str, text: str) -> None:
    """Tokens in order (``<name>_words``) and the cleaned text (``<name>_clean``)."""
    PARTS[f"{name}_words"] = f"""
SELECT t.{key}, t.place, coalesce(l.lemma, t.word) AS term FROM (
  SELECT {key}, unnest(words) AS word, generate_subscripts(words, 1) AS place
  FROM (SELECT {key}, {_content(text)} AS words FROM {source})
) t LEFT JOIN lemmas l ON l.word = t.word"""
    PARTS[f"{name}_clean"] = f"""
SELECT s.{key}, coalesce(string_agg(w.term, ' ' ORDER BY w.place), '') AS cleaned,
       count(w.term) AS n_tokens
FROM {source} s LEFT JOIN {name}_words w ON w.{key} = s.{key} GROUP BY s.{key}"""


def _query_weights(name: str) -> None:
    PARTS[f"{name}_weights"] = f"""
SELECT query_id, term, weight / sqrt(sum(weight * weight) OVER (PARTITION BY query_id)) AS weight
FROM (
  SELECT q.query_id, q.term, count(*) * any_value(s.idf) AS weight
  FROM {name}_words q JOIN stats s ON s.term = q.term GROUP BY q.query_id, q.term
)"""


def _sparse_ranks(name: str) -> None:
    """Every document ranked for every query that is not blank."""
    PARTS[f"{name}_sparse"] = f"""
SELECT query_id, doc_id, score,
       row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
FROM (
  SELECT q.query_id, d.doc_id, {_score('coalesce(m.score, 0)')} AS score
  FROM (SELECT query_id FROM {name}_clean WHERE n_tokens > 0) q CROSS JOIN documents d
  LEFT JOIN (
    SELECT a.query_id, b.doc_id, sum(a.weight * b.weight) AS score
    FROM {name}_weights a JOIN doc_weights b ON a.term = b.term GROUP BY ALL
  ) m ON m.query_id = q.query_id AND m.doc_id = d.doc_id
)"""


_clean_words("all_docs", "documents", "doc_id", "text")
for _name in ["asked", "asked_parts"]:
    _clean_words(_name, _name, "query_id", "query")
    _query_weights(_name)
    _sparse_ranks(_name)

PARTS["given_queries"] = """
SELECT item_id AS query_id, embedding::DOUBLE[] AS v FROM embeddings JOIN benchmark
ON vec_id = item_id"""
PARTS["given_docs"] = "SELECT vec_id AS doc_id, embedding::DOUBLE[] AS v FROM embeddings"
PARTS["given_part_queries"] = """
SELECT p_partkey AS query_id, embedding::DOUBLE[] AS v FROM embeddings JOIN part
ON vec_id = p_partkey"""

PARTS["chunks"] = f"""
SELECT doc_id, (start // 80)::INT AS chunk_no,
       array_to_string(words[start + 1 : start + 100], ' ') AS text
FROM (
  SELECT doc_id, words, unnest(range(0, len(words), 80)) AS start
  FROM (SELECT doc_id, {_words('text')} AS words FROM documents)
)"""


def _hash_vectors(name: str, source: str, keys: str, text: str, twice: bool) -> None:
    """Dense hash vectors of a text column, scaled once or twice."""
    words = _words(f"translate(lower(coalesce({text}, '')), {_PUNCT}, '')")
    on = " AND ".join(f"s.{k} = h.{k}" for k in keys.split(", "))
    keys_s = ", ".join(f"s.{k}" for k in keys.split(", "))
    PARTS[f"{name}_cells"] = f"""
SELECT {keys}, ('0x' || substr(md5(word), 1, 8))::BIGINT % 64 AS pos,
       sum(CASE WHEN ('0x' || substr(md5(word), 9, 1))::INT < 8 THEN 1 ELSE -1 END) AS n
FROM (SELECT {keys}, unnest({words}) AS word FROM {source}) GROUP BY ALL"""
    PARTS[f"{name}_scaled"] = f"""
SELECT {keys}, pos, (n / sqrt(sum(n * n) OVER (PARTITION BY {keys})))::FLOAT::DOUBLE AS x
FROM {name}_cells WHERE n <> 0"""
    if twice:
        PARTS[f"{name}_scaled_again"] = f"""
SELECT {keys}, pos, (x / sqrt(sum(x * x) OVER (PARTITION BY {keys})))::FLOAT::DOUBLE AS x
FROM {name}_scaled"""
    cells = f"{name}_scaled_again" if twice else f"{name}_scaled"
    PARTS[f"{name}_vectors"] = f"""
SELECT {keys_s}, list(coalesce(h.x, 0) ORDER BY p.pos) AS v
FROM {source} s CROSS JOIN (SELECT unnest(range(64)) AS pos) p
LEFT JOIN {cells} h ON {on} AND h.pos = p.pos GROUP BY {keys_s}"""


_hash_vectors("docs_hash", "documents", "doc_id", "text", twice=False)
_hash_vectors("chunks_hash", "chunks", "doc_id, chunk_no", "text", twice=True)
_hash_vectors("raw_hash", "asked", "query_id", "query", twice=False)
_hash_vectors("raw_unit", "asked", "query_id", "query", twice=True)
PARTS["asked_not_blank"] = "SELECT query_id, cleaned FROM asked_clean WHERE cleaned <> ''"
_hash_vectors("clean_unit", "asked_not_blank", "query_id", "cleaned", twice=True)


def _cosine(a: str, b: str) -> str:
    # DuckDB gives NaN for a vector without length.
    return _score(f"coalesce(nullif(list_cosine_similarity({a}, {b}), 'NaN'::DOUBLE), 0)")


def _dense_ranks(name: str, queries: str, docs: str) -> None:
    PARTS[name] = f"""
SELECT query_id, doc_id, score,
       row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank
FROM (
  SELECT q.query_id, d.doc_id, {_cosine('q.v', 'd.v')} AS score FROM {queries} q, {docs} d
)"""


def _hybrid_ranks(name: str, sparse: str, queries: str, docs: str, k: int) -> None:
    PARTS[name] = f"""
SELECT query_id, doc_id, score,
       row_number() OVER (PARTITION BY query_id ORDER BY score DESC, sparse_rank) AS rank
FROM (
  SELECT q.query_id, d.doc_id, s.rank AS sparse_rank, {_cosine('q.v', 'd.v')} AS score
  FROM {sparse} s JOIN {docs} d ON d.doc_id = s.doc_id JOIN {queries} q ON q.query_id = s.query_id
  WHERE s.rank <= {k}
)"""


_dense_ranks("given_dense", "given_queries", "given_docs")
_dense_ranks("hash_dense", "raw_hash_vectors", "docs_hash_vectors")
_hybrid_ranks("given_hybrid", "asked_sparse", "given_queries", "given_docs", 1000)
_hybrid_ranks("given_hybrid_50", "asked_sparse", "given_queries", "given_docs", 50)
_hybrid_ranks("hash_hybrid_60", "asked_sparse", "raw_hash_vectors", "docs_hash_vectors", 60)
_hybrid_ranks("hash_hybrid", "asked_sparse", "raw_hash_vectors", "docs_hash_vectors", 1000)
_hybrid_ranks("parts_hybrid", "asked_parts_sparse", "given_part_queries", "given_docs", 1)

PARTS["chunk_ranks"] = f"""
SELECT query_id, doc_id, chunk_no, score,
       row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, chunk_no) AS rank
FROM (
  SELECT q.query_id, c.doc_id, c.chunk_no, {_score('list_dot_product(q.v, c.v)')} AS score
  FROM clean_unit_vectors q, chunks_hash_vectors c
)"""

PARTS["chunk_hits"] = """
SELECT r.query_id, r.rank, r.doc_id, r.chunk_no, c.text, r.score
FROM chunk_ranks r JOIN chunks c ON c.doc_id = r.doc_id AND c.chunk_no = r.chunk_no
WHERE r.rank <= 5"""


def _chunks_in(name: str, hybrid: str) -> None:
    PARTS[name] = f"""
SELECT query_id, rank, doc_id, chunk_no, score, text AS snippet FROM (
  SELECT q.query_id, c.doc_id, c.chunk_no, t.text, {_score('list_dot_product(q.v, c.v)')} AS score,
         row_number() OVER (PARTITION BY q.query_id
           ORDER BY {_score('list_dot_product(q.v, c.v)')} DESC, c.doc_id, c.chunk_no) AS rank
  FROM {hybrid} h JOIN chunks_hash_vectors c ON c.doc_id = h.doc_id
  JOIN chunks t ON t.doc_id = c.doc_id AND t.chunk_no = c.chunk_no
  JOIN raw_unit_vectors q ON q.query_id = h.query_id
  WHERE h.rank <= 50
) WHERE rank <= 10"""


_chunks_in("chunks_in_60", "hash_hybrid_60")
_chunks_in("chunks_in_hybrid", "hash_hybrid")

# Prompts.
_INSTRUCTION = (
    "CASE instruction_key "
    + " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in INSTRUCTIONS.items())
    + f" ELSE {_text(INSTRUCTIONS['default'])} END"
)
_KEYS = "[" + ", ".join(_text(k) for k in [*INSTRUCTIONS, "unknown"]) + "]"
_QUESTION = r"e'\n\nQuestion: ' || query || e'\nAnswer:'"


def _prompt_budgets(name: str, source: str) -> None:
    PARTS[name] = f"""
SELECT *, 512 - 50 - len({_words(f"{_INSTRUCTION} || {_QUESTION}")}) AS budget,
       {_INSTRUCTION} AS instruction
FROM {source}"""


PARTS["asked_keys"] = f"""
SELECT query_id, query, {_KEYS}[query_id % 5 + 1] AS instruction_key FROM asked"""
PARTS["asked_comparative"] = "SELECT *, 'comparative' AS instruction_key FROM asked"
PARTS["asked_default"] = "SELECT *, 'default' AS instruction_key FROM asked"
PARTS["asked_parts_default"] = "SELECT *, 'default' AS instruction_key FROM asked_parts"
_prompt_budgets("budgets", "asked_keys")
_prompt_budgets("comparative_budgets", "asked_comparative")
_prompt_budgets("default_budgets", "asked_default")
_prompt_budgets("parts_budgets", "asked_parts_default")


def _packed(name: str, budgets: str, hits: str, where: str = "true") -> None:
    """Passages with their running cost, and the prompt of each query."""
    PARTS[f"{name}_packed"] = f"""
SELECT *, tokens_so_far <= budget AS packed FROM (
  SELECT h.*, b.budget, passage, len({_words('passage')}) AS tokens,
         sum(len({_words('passage')})) OVER (PARTITION BY h.query_id ORDER BY h.score DESC, h.rank)
           AS tokens_so_far
  FROM (
    SELECT *, 'Document (ID: ' || doc_id || '): ' || text AS passage FROM {hits} WHERE {where}
  ) h JOIN {budgets} b ON b.query_id = h.query_id
)"""
    PARTS[f"{name}_prompts"] = rf"""
SELECT b.query_id, b.query, count(p.rank) AS n_retrieved,
       b.instruction || e'\n\n' || concat_ws(e'\n\n', 'Context:',
         string_agg(p.passage, e'\n\n' ORDER BY p.score DESC, p.rank) FILTER (WHERE p.packed))
         || e'\n\nQuestion: ' || b.query || e'\nAnswer:' AS prompt
FROM {budgets} b LEFT JOIN {name}_packed p ON p.query_id = b.query_id
GROUP BY b.query_id, b.query, b.instruction"""


def _with_text(name: str, hits: str, k: int) -> None:
    PARTS[name] = f"""
SELECT h.query_id, h.rank, h.doc_id, h.score, coalesce(d.text, '{NO_CONTENT}') AS text
FROM {hits} h LEFT JOIN documents d ON d.doc_id = h.doc_id WHERE h.rank <= {k}"""


_packed("low", "budgets", "chunk_hits", "score >= 0.3")
_packed("high", "budgets", "chunk_hits", "score >= 0.7")
_packed("high_comparative", "comparative_budgets", "chunk_hits", "score >= 0.7")
_with_text("hybrid_texts", "given_hybrid_50", 3)
_packed("hybrid", "budgets", "hybrid_texts")
_with_text("hash_hybrid_texts", "hash_hybrid", 3)
_packed("hash_hybrid_comparative", "comparative_budgets", "hash_hybrid_texts")
_packed("hash_hybrid_default", "default_budgets", "hash_hybrid_texts")
_with_text("parts_texts", "parts_hybrid", 3)
_packed("parts", "parts_budgets", "parts_texts")


def _needed(sql: str) -> list[str]:
    """Names of the parts a statement uses, directly or not, in order of use."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN|,)\s+(\w+)", text):
            if name in PARTS and name not in found:
                visit(PARTS[name])
                found.append(name)

    visit(sql)
    return found


def _with(sql: str) -> str:
    parts = ", ".join(f"{n} AS MATERIALIZED ({PARTS[n]})" for n in _needed(sql))
    return f"WITH {parts} {sql}" if parts else sql


def _flat(source: str, keys: str) -> str:
    return f"SELECT {keys}, pos::INT AS pos, round(x, 6) AS value FROM {source} WHERE round(x, 6) <> 0"


def _search(ranks: str, n: int) -> str:
    return f"""
SELECT r.query_id, r.rank, r.doc_id, r.score, {_snippet('d.text')} AS snippet
FROM {ranks} r LEFT JOIN documents d ON d.doc_id = r.doc_id WHERE r.rank <= {n}"""


def _fixed_reply(prompts: str) -> str:
    return f"""
SELECT query_id, CASE WHEN n_retrieved > 0 THEN prompt END AS prompt,
       CASE WHEN n_retrieved = 0 THEN '{NOTHING_FOUND}' END AS response, n_retrieved
FROM {prompts}"""


def _method_rows(place: int, method: str, source: str, columns: str, plus: str = "") -> str:
    return f"""
SELECT r.query_id * 7 + {place} AS request_id, a.query, 'documents' AS dataset,
       '{method}' AS method, {columns}
FROM {source} r JOIN asked a ON a.query_id = r.query_id {plus}"""


def _prompt_rows(place: int, method: str, source: str, response: str) -> str:
    no_hit = "NULL AS rank, NULL AS doc_id, NULL AS score, NULL AS snippet, r.prompt"
    return _method_rows(place, method, source, f"{no_hit}, {response} AS response, r.n_retrieved")


def _dispatch() -> str:
    """All methods in one result; the request id numbers query and method."""
    rows = _method_rows
    hit = "r.rank, r.doc_id, r.score, {} AS snippet, NULL AS prompt, NULL AS response, NULL AS n_retrieved"
    text = "LEFT JOIN documents d ON d.doc_id = r.doc_id WHERE r.rank <= 10"
    short = hit.format(_snippet("d.text"))
    return " UNION ALL ".join(
        [
            rows(0, "tfidf", "asked_sparse", short, text),
            rows(1, "embedding_brute_force", "hash_dense", short, text),
            rows(2, "embedding_faiss", "chunk_hits", hit.format("left(r.text, 150) || '...'"), "WHERE r.score >= 0.7"),
            rows(3, "hybrid", "hash_hybrid", short, text),
            _prompt_rows(4, "rag_with_faiss", "high_comparative_prompts", "NULL"),
            rows(5, "faiss_with_basics", "chunks_in_hybrid", hit.format("r.snippet")),
            _prompt_rows(6, "rag_with_basics", "hash_hybrid_replies", "r.response"),
        ]
    )


PARTS["hash_hybrid_replies"] = _fixed_reply("hash_hybrid_comparative_prompts")
PARTS["hash_hybrid_default_replies"] = _fixed_reply("hash_hybrid_default_prompts")
PARTS["dispatched"] = _dispatch()

_STATEMENTS = {
    "doc_scan": "SELECT doc_id, text FROM documents",
    "doc_scan_other_id": "SELECT item_id AS doc_id, text FROM benchmark",
    "doc_ids": "SELECT doc_id FROM documents",
    "doc_string_ids": "SELECT doc_id::VARCHAR AS doc_id, text FROM documents",
    "doc_lookup": "SELECT doc_id, text FROM documents WHERE doc_id = 42",
    "doc_lookup_batch": """
SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT c_custkey FROM customer)""",
    "doc_scan_keep_last": """
SELECT conv_id AS doc_id, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id""",
    "queries_tsv": r"""
SELECT item_id::VARCHAR AS query_id, CASE WHEN item_id % 3 = 0 THEN 'again' || chr(9) || item_id
  ELSE trim(regexp_replace(text, '[\x00-\x20]+', ' ', 'g')) END AS query FROM benchmark""",
    "queries_jsonl": r"""
SELECT item_id::VARCHAR AS query_id, CASE WHEN item_id % 3 = 0 THEN 'again'
  ELSE trim(regexp_replace(text, '[\x00-\x20]+', ' ', 'g')) END AS query FROM benchmark""",
    "qrels_spaced": """
SELECT (doc_id % 7)::VARCHAR AS query_id, doc_id::VARCHAR AS doc_id,
       CASE WHEN doc_id % 3 = 0 THEN 4 ELSE quality END AS relevance FROM labels""",
    "qrels_tsv": """
SELECT (doc_id % 7)::VARCHAR AS query_id, doc_id::VARCHAR AS doc_id,
       CASE WHEN doc_id % 3 = 0 THEN -2 ELSE toxic END AS relevance FROM labels""",
    "normalised_text": f"SELECT doc_id, {_normal('text')} AS normalised FROM documents",
    "tokenize": f"""
SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, {_tokens('text')} AS t FROM documents)""",
    "whitespace_tokens": f"""
SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, {_words('text')} AS t FROM documents)""",
    "stopword_filter": f"""
SELECT doc_id, array_to_string({_content('text')}, ' ') AS tokens FROM documents""",
    "noun_lemma_pairs": "SELECT word, lemma, n_docs FROM lemmas",
    "clean_text": "SELECT doc_id, cleaned, n_tokens FROM all_docs_clean",
    "snippets": f"""
SELECT doc_id, {_snippet('text')} AS snippet, left(text, 150) || '...' AS suffixed FROM documents""",
    "bag_of_words": """
SELECT doc_id, term, tf FROM bag UNION ALL
SELECT doc_id, NULL, 1 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM bag)""",
    "tfidf_term_stats": "SELECT term, df, round(idf, 6) AS idf FROM stats",
    "tfidf_weights": "SELECT doc_id, term, round(weight, 6) AS weight FROM doc_weights",
    "tfidf_query_weights": "SELECT query_id, term, round(weight, 6) AS weight FROM asked_weights",
    "tfidf_search": _search("asked_sparse", 10),
    "tfidf_search_postings": _search("asked_sparse", 10),
    "tfidf_zero_fill_postings": """
SELECT query_id, rank, doc_id, score FROM asked_parts_sparse WHERE rank <= 10""",
    "tfidf_two_stage": _search("asked_sparse", 4),
    "tfidf_zero_fill": """
SELECT query_id, rank, doc_id, score FROM asked_parts_sparse WHERE rank <= 10""",
    "l2_normalize": """
SELECT doc_id, pos, round(x, 6) AS value FROM (
  SELECT vec_id AS doc_id, generate_subscripts(embedding, 1)::INT - 1 AS pos,
         (unnest(embedding)::DOUBLE / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])))
           ::FLOAT::DOUBLE AS x
  FROM embeddings
) WHERE round(x, 6) <> 0""",
    "document_embeddings": _flat("docs_hash_scaled", "doc_id"),
    "query_records": """
SELECT a.query_id, a.query AS original_query, c.cleaned AS preprocessed_text,
       h.pos::INT AS pos, round(h.x, 6) AS value
FROM asked a JOIN asked_clean c ON c.query_id = a.query_id
JOIN raw_hash_scaled h ON h.query_id = a.query_id WHERE round(h.x, 6) <> 0""",
    "embedding_search": _search("given_dense", 10),
    "embedding_search_encoded": _search("hash_dense", 10),
    "chunks": "SELECT doc_id, chunk_no, text FROM chunks",
    "chunk_embeddings": _flat("chunks_hash_scaled_again", "doc_id, chunk_no"),
    "chunk_search": "SELECT * FROM chunk_hits WHERE score >= 0.7",
    "chunk_search_low_threshold": "SELECT * FROM chunk_hits WHERE score >= 0.3",
    "chunk_search_grouped": "SELECT * FROM chunk_hits WHERE score >= 0.7",
    "chunk_search_grouped_low_threshold": "SELECT * FROM chunk_hits WHERE score >= 0.3",
    "chunk_search_in_candidates": "SELECT * FROM chunks_in_60",
    "hybrid_candidates": """
SELECT s.query_id, s.doc_id, s.rank AS sparse_rank
FROM asked_sparse s JOIN given_docs d ON d.doc_id = s.doc_id WHERE s.rank <= 50""",
    "hybrid_search": _search("given_hybrid", 10),
    "hybrid_search_narrow": _search("given_hybrid_50", 10),
    "instruction_lookup": "SELECT query_id, instruction_key, instruction FROM budgets",
    "prompt_budget": "SELECT query_id, budget FROM budgets",
    "prompt_packing": """
SELECT query_id, rank, doc_id, chunk_no, tokens, packed FROM low_packed""",
    "prompt_text": "SELECT query_id, query, prompt FROM low_prompts",
    "prompt_text_default": "SELECT query_id, prompt, n_retrieved FROM high_prompts",
    "prompt_context": """
SELECT query_id, (rank - 1)::INT AS pos, doc_id, chunk_no, text, score FROM low_packed""",
    "prompt_from_hybrid": _fixed_reply("hybrid_prompts"),
    "prompt_without_hits": _fixed_reply("parts_prompts"),
    "dispatch": _dispatch(),
    "request_validation": """
SELECT item_id AS request_id, 'default' AS instruction_key,
       CASE WHEN item_id % 3 = 0 OR (item_id % 4 <> 0 AND item_id % 7 = 0)
              THEN 'Missing query, dataset, or method'
            WHEN item_id % 4 = 0 THEN 'Invalid method: bm25'
            WHEN item_id % 5 = 0 THEN 'Unknown dataset: elsewhere' END AS error
FROM benchmark""",
    "document_requests": """
SELECT request_id, doc_id, dataset, content,
       CASE WHEN doc_id IS NULL OR dataset = '' THEN 'Missing doc_id or dataset'
            WHEN content IS NULL THEN 'Document not found' END AS error
FROM (
  SELECT c.request_id, c.doc_id, c.dataset,
         CASE c.dataset WHEN 'documents' THEN d.text WHEN 'benchmark' THEN b.text END AS content
  FROM (
    SELECT c_custkey AS request_id,
           CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS doc_id,
           CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 2 = 0 THEN 'benchmark'
                ELSE 'documents' END AS dataset
    FROM customer
  ) c LEFT JOIN documents d ON d.doc_id = c.doc_id LEFT JOIN benchmark b ON b.item_id = c.doc_id
)""",
    "dispatch_repeated_ids": f"""
SELECT a.* REPLACE (a.request_id - a.request_id % 14 + a.request_id % 7 AS request_id)
FROM (
  SELECT * FROM dispatched WHERE method IN ('tfidf', 'embedding_faiss', 'rag_with_basics')
  UNION ALL SELECT * FROM dispatched WHERE method IN ('tfidf', 'embedding_faiss')
  UNION ALL {_prompt_rows(6, 'rag_with_basics', 'hash_hybrid_default_replies', 'r.response')}
) a""",
    "streamed_requests": "SELECT * FROM dispatched WHERE request_id // 7 % 5 <> 0",
    "streamed_rejects": """
SELECT query_id * 7 + place AS request_id, query, 'bm25' AS method, 'Invalid method: bm25' AS error
FROM asked, unnest(range(7)) AS t(place) WHERE query_id % 5 = 0""",
}

ORACLES = {name: _with(sql) for name, sql in _STATEMENTS.items()}
