"""The SQL of the queries that it can express, in DuckDB's dialect."""

WORDS = r"[^\x20\x09-\x0D]+"

#: Words, windows of 13 of them by document, and the words that an earlier document's window covers.
SUBSTRING_DEDUP = rf"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS words FROM documents
),
starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS place FROM docs WHERE len(words) >= 13
),
windows AS MATERIALIZED (
  SELECT doc_id, place, array_to_string(words[place:place + 12], ' ') AS held FROM starts
),
earliest AS (SELECT held, min(doc_id) AS origin FROM windows GROUP BY held),
gone AS (
  SELECT doc_id, list(DISTINCT place + k) AS places
  FROM windows JOIN earliest USING (held), range(0, 13) AS t(k)
  WHERE origin < doc_id GROUP BY doc_id
),
told AS (
  SELECT d.doc_id, d.words, coalesce(g.places, []) AS places FROM docs d LEFT JOIN gone g ON g.doc_id = d.doc_id
),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept
  FROM (SELECT doc_id, places, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM told)
  WHERE NOT list_contains(places, place) GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM told t LEFT JOIN kept k ON k.doc_id = t.doc_id"""


def _clustering(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    parts = [
        f"""
v AS MATERIALIZED (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS p
  FROM embeddings
  WHERE len(embedding) = {dim} AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
)""",
        f"""
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, p FROM v
  QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id)) <= {k}
)""",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""
near{r} AS MATERIALIZED (
  SELECT vec_id, v.p AS p, c, CAST(list_sum([(v.p[i] - c{r}.p[i]) * (v.p[i] - c{r}.p[i]) FOR i IN range(1, {dim} + 1)]) AS BIGINT) AS d
  FROM v, c{r}
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1
)"""
        )
        if r < rounds:
            parts.append(
                f"""
mean{r} AS (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS p
  FROM (SELECT c, i, sum(p[i]) AS s, count(*) AS n FROM near{r}, range(1, {dim} + 1) AS t(i) GROUP BY c, i) GROUP BY c
),
c{r + 1} AS MATERIALIZED (
  SELECT c{r}.c, coalesce(mean{r}.p, c{r}.p) AS p FROM c{r} LEFT JOIN mean{r} ON mean{r}.c = c{r}.c
)"""
            )
    return (
        "WITH "
        + ",".join(parts)
        + f"""
SELECT vec_id, CAST(n.c AS INT) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY n.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string([CAST(x AS VARCHAR) FOR x IN f.p], ',')) AS centroid_sha256
FROM near{rounds} n JOIN c{rounds} f ON f.c = n.c"""
    )


CENTROID_CLUSTERING = _clustering()
