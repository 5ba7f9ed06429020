"""DuckDB statements of the same rules, used as the correctness oracle.

They are written independently of the Spark code: window functions over the
whole table where Spark uses the two-level prefix sum, a sparse SQL dot
product where Spark uses dense Arrow matmuls, ``contains`` over all pairs where
Spark uses an Aho-Corasick scan.  Tables are the pre-registered views
(``documents``, ``benchmark``, ``embeddings``, ...)."""

from __future__ import annotations

from ..functions.text import (DEFAULT_CHUNK_OVERLAP, DEFAULT_CHUNK_WORDS,
                              NON_TOKEN_RUN, WHITESPACE_RUN)


def clean_sql(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{WHITESPACE_RUN}', ' ', 'g'))"


def tokens_sql(expr: str) -> str:
    return (f"list_filter(string_split(trim(regexp_replace(lower({expr}), "
            f"'{NON_TOKEN_RUN}', ' ', 'g')), ' '), lambda t: t <> '')")


def words_sql(expr: str) -> str:
    return f"list_filter(string_split({clean_sql(expr)}, ' '), lambda t: t <> '')"


def bucket_sql(tok: str, dim: int) -> str:
    return f"((('0x' || substr(md5({tok}), 1, 8))::BIGINT) % {dim})"


def chunks_ctes(table: str = "documents", id_col: str = "doc_id", text_col: str = "text",
                cw: int = DEFAULT_CHUNK_WORDS, ov: int = DEFAULT_CHUNK_OVERLAP) -> str:
    step = max(1, cw - ov)
    return f"""
ch_clean AS (SELECT {id_col} AS doc_id, {clean_sql(text_col)} AS t FROM {table}),
ch_words AS (SELECT doc_id, string_split(t, ' ') AS ws FROM ch_clean WHERE length(t) > 0),
ch_count AS (SELECT doc_id, ws, least((len(ws) + {step - 1}) // {step},
             (greatest(len(ws) - {cw}, 0) + {step - 1}) // {step} + 1) AS nc FROM ch_words),
ch_pos AS (SELECT doc_id, ws, unnest(range(0, nc)) AS i FROM ch_count),
chunks AS (
  SELECT CAST(row_number() OVER (ORDER BY doc_id, i) - 1 AS BIGINT) AS chunk_id,
         doc_id, CAST(doc_id AS VARCHAR) AS source_name, CAST(i AS BIGINT) AS chunk_idx,
         CAST(doc_id AS VARCHAR) || '::chunk' || CAST(i AS VARCHAR) AS chunk_ref,
         array_to_string(ws[i * {step} + 1 : i * {step} + {cw}], ' ') AS text
  FROM ch_pos)"""


def queries_cte() -> str:
    return "qs AS (SELECT CAST(item_id AS VARCHAR) AS qid, text AS query FROM benchmark)"


def sparse_ctes(dim: int) -> str:
    """Sparse term counts of chunks (cb) and queries (qb) and their squared norms."""
    return f"""
ctok AS (SELECT chunk_id, unnest({words_sql('text')}) AS tok FROM chunks),
cb AS (SELECT chunk_id, {bucket_sql('tok', dim)} AS bucket, count(*) AS n FROM ctok GROUP BY ALL),
cn AS (SELECT chunk_id, sum(n * n) AS ss FROM cb GROUP BY chunk_id),
qtok AS (SELECT qid, unnest({words_sql('query')}) AS tok FROM qs),
qb AS (SELECT qid, {bucket_sql('tok', dim)} AS bucket, count(*) AS n FROM qtok GROUP BY ALL),
qn AS (SELECT qid, sum(n * n) AS ss FROM qb GROUP BY qid)"""


def knn_ctes(dim: int, candidates: int) -> str:
    """cands(qid, id, score, rank): exact cosine top-N over all (query, chunk) pairs."""
    return sparse_ctes(dim) + f""",
dots AS (SELECT qb.qid, cb.chunk_id, sum(qb.n * cb.n) AS dot
         FROM qb JOIN cb USING (bucket) GROUP BY ALL),
pairs AS (SELECT qs.qid, chunks.chunk_id FROM qs CROSS JOIN chunks),
scored AS (
  SELECT p.qid, p.chunk_id AS id,
         CASE WHEN coalesce(qn.ss, 0) > 0 AND coalesce(cn.ss, 0) > 0
              THEN coalesce(d.dot, 0) / (sqrt(qn.ss::DOUBLE) * sqrt(cn.ss::DOUBLE))
              ELSE 0.0 END AS score
  FROM pairs p
  LEFT JOIN dots d ON d.qid = p.qid AND d.chunk_id = p.chunk_id
  LEFT JOIN qn ON qn.qid = p.qid
  LEFT JOIN cn ON cn.chunk_id = p.chunk_id),
ranked AS (SELECT qid, id, score,
           row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM scored),
cands AS (SELECT * FROM ranked WHERE rank <= {candidates})"""


def rollup_ctes(k: int) -> str:
    """From cands: top-k hits, document roll-up (docs) and responses (resp)."""
    return f""",
hits AS (SELECT qid, id, rank FROM cands WHERE rank <= {k}),
named AS (SELECT h.qid, h.rank, c.source_name FROM hits h JOIN chunks c ON c.chunk_id = h.id),
best AS (SELECT qid, source_name, min(rank) AS best FROM named GROUP BY ALL),
docs AS (SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY best) AS INTEGER) AS rank,
         source_name FROM best),
resp AS (
  SELECT qs.qid, qs.query,
         coalesce((SELECT list(d.source_name ORDER BY d.rank) FROM docs d WHERE d.qid = qs.qid),
                  []::VARCHAR[]) AS response
  FROM qs)"""


def truth_cte(table: str = "documents") -> str:
    return f""",
truth AS (SELECT DISTINCT qs.qid, CAST(d.doc_id AS VARCHAR) AS relevant
          FROM qs JOIN {table} d ON contains({clean_sql('d.text')}, {clean_sql('qs.query')}))"""


def metrics_ctes(k: int) -> str:
    return f""",
rlong AS (SELECT qid, CAST(unnest(range(1, len(response) + 1)) AS BIGINT) AS rank,
          unnest(response) AS source_name FROM resp),
nrel AS (SELECT qid, count(DISTINCT relevant) AS n_relevant FROM truth GROUP BY qid),
hitrows AS (SELECT r.qid, r.rank FROM rlong r JOIN (SELECT DISTINCT qid, relevant FROM truth) t
            ON t.qid = r.qid AND t.relevant = r.source_name WHERE r.rank <= {k}),
hagg AS (SELECT qid, count(*) AS hits, sum(1.0 / log2(rank + 1)) AS dcg FROM hitrows GROUP BY qid),
perq AS (
  SELECT n.qid, CAST(n.n_relevant AS BIGINT) AS n_relevant,
         CAST(coalesce(h.hits, 0) AS BIGINT) AS hits,
         coalesce(h.hits, 0) / {float(k)} AS precision,
         CASE WHEN n.n_relevant = 0 THEN 0.0 ELSE coalesce(h.hits, 0) / n.n_relevant END AS recall,
         CASE WHEN least(n.n_relevant, {k}) = 0 THEN 0.0
              ELSE coalesce(h.dcg, 0.0) / (SELECT sum(1.0 / log2(i + 1))
                                            FROM range(1, least(n.n_relevant, {k}) + 1) t(i))
         END AS ndcg
  FROM nrel n JOIN (SELECT DISTINCT qid FROM resp) a ON a.qid = n.qid
  LEFT JOIN hagg h ON h.qid = n.qid)"""


def r6(col: str, alias: str | None = None) -> str:
    return f"round({col}, 6) AS {alias or col}"


# ------------------------------------------------------------------ vector index

def emb_ctes(nlist: int, n_train: int) -> str:
    """Unit-scaled embeddings (u), the adaptive list count (nl), first-k
    centroids (cent), coarse scores (cs) and the list assignment (asg)."""
    return f"""
u AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v,
             sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n
      FROM embeddings),
train AS (SELECT * FROM u QUALIFY row_number() OVER (ORDER BY id) <= {n_train}),
nl AS (SELECT CASE WHEN count(*) < {nlist} THEN greatest(1, CAST(floor(count(*) / 8) AS INTEGER))
              ELSE {nlist} END AS nlist FROM u),
cent AS (SELECT CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS list_id, v AS c, n AS cn
         FROM train QUALIFY row_number() OVER (ORDER BY id) <= (SELECT nlist FROM nl)),
cs AS (SELECT u.id, cent.list_id, list_dot_product(u.v, cent.c) / (u.n * cent.cn) AS raw
       FROM u CROSS JOIN cent),
asg AS (SELECT id, list_id FROM cs
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(raw, 9) DESC, list_id) = 1)"""


def _means(rows: str, keys: str, vec: str, dim: int) -> str:
    """Component-wise means of a list column by ``keys``, rounded to whole numbers."""
    return f"""(SELECT {keys}, list(v ORDER BY j) AS m FROM (
   SELECT {keys}, j, floor(sum(v) / count(*) + 0.5) AS v FROM (
     SELECT {keys}, unnest({vec}) AS v, unnest(range(0, {dim})) AS j FROM {rows}) GROUP BY ALL) GROUP BY {keys})"""


def _grid_bits(dim: int) -> int:
    return (50 - (dim - 1).bit_length()) // 2 - 2


def trained_ctes(nlist: int, iters: int, dim: int, vectors: str = "") -> str:
    """The names of :func:`emb_ctes` with centroids after ``iters`` unrolled rounds of
    k-means on whole numbers (all vectors train, first rows start, cosine)."""
    base = emb_ctes(nlist, 1 << 40).split("cent AS (")[0] if not vectors else vectors
    out = base + f"""
gs AS MATERIALIZED (SELECT pow(2, {_grid_bits(dim)} - 1 - floor(log2(max(list_max(list_transform(v, lambda x: abs(x))))))) AS raw,
       pow(2, {_grid_bits(dim)} - 1) AS s FROM u),
g0 AS (SELECT id, list_transform(v, lambda x: floor(x * raw + 0.5)) AS x0 FROM u, gs),
gx AS MATERIALIZED (
  SELECT id, list_transform(x0, lambda x: CASE WHEN q > 0 THEN floor(x / sqrt(q) * s + 0.5) ELSE 0.0 END) AS x
  FROM (SELECT id, x0, list_dot_product(x0, x0) AS q FROM g0), gs),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS list_id, x AS c FROM gx
       QUALIFY row_number() OVER (ORDER BY id) <= (SELECT nlist FROM nl)),"""
    for r in range(iters + 1):
        out += f"""
a{r} AS MATERIALIZED (SELECT id, CAST(2047 - (k & 2047) AS INTEGER) AS list_id FROM (
  SELECT id, max(CAST(list_dot_product(gx.x, c.c) AS BIGINT) * 2048 + (2047 - list_id)) AS k FROM gx CROSS JOIN c{r} c GROUP BY id)),"""
        if r < iters:
            means = _means(f"a{r} JOIN gx USING (id)", "list_id", "x", dim)
            out += f"""
c{r + 1} AS MATERIALIZED (SELECT c.list_id, coalesce(n.t, c.c) AS c FROM c{r} c LEFT JOIN (
  SELECT list_id, list_transform(m, lambda t: floor(t / sqrt(q) * s + 0.5)) AS t
  FROM (SELECT list_id, m, list_dot_product(m, m) AS q FROM {means}), gs WHERE q > 0) n ON n.list_id = c.list_id),"""
    return out + f"""
cent AS MATERIALIZED (SELECT list_id, c, sqrt(list_dot_product(c, c)) AS cn FROM (
  SELECT list_id, list_transform(c, lambda x: CAST(CAST(x / s AS FLOAT) AS DOUBLE)) AS c FROM c{iters}, gs)),
""" + _with_cosine_lists()


def _inner_rounds(a: str, c: str, rows: str, join: str, iters: int, dim: int) -> str:
    """Unrolled rounds from centres ``{c}0(..., list_id, c)``: assignments ``{a}r``."""
    out = ""
    for r in range(iters + 1):
        out += f"""
{a}{r} AS MATERIALIZED (SELECT id, CAST(2047 - (k & 2047) AS INTEGER) AS list_id FROM (
  SELECT id, max(CAST(list_dot_product(x.x, c.c) AS BIGINT) * 2048 + (2047 - c.list_id)) AS k
  FROM {rows} x {join.format(c=f"{c}{r}")} GROUP BY id)),"""
        if r < iters:
            means = _means(f"{a}{r} JOIN gx USING (id)", "list_id", "x", dim)
            out += f"""
{c}{r + 1} AS MATERIALIZED (SELECT c.* REPLACE (coalesce(n.t, c.c) AS c) FROM {c}{r} c LEFT JOIN (
  SELECT list_id, list_transform(m, lambda t: floor(t / sqrt(q) * s + 0.5)) AS t
  FROM (SELECT list_id, m, list_dot_product(m, m) AS q FROM {means}), gs WHERE q > 0) n ON n.list_id = c.list_id),"""
    return out


def tree_ctes(nlist: int, cells: int, cell_lists: int, iters: int, dim: int) -> str:
    """A two-level quantiser over all embeddings: cells (tops: cell, c; tx: id, x, cell)
    and the lists in them (ls: cell, list_id, c; la: id, list_id)."""
    head = trained_ctes(nlist, 0, dim).split("c0 AS MATERIALIZED (")[0]
    return head + f"""
tc0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS list_id, x AS c FROM gx
       QUALIFY row_number() OVER (ORDER BY id) <= {cells}),""" + _inner_rounds(
        "ta", "tc", "gx", "CROSS JOIN {c} c", iters, dim) + f"""
tn AS (SELECT list_id AS top, count(*) AS n, CAST(row_number() OVER (ORDER BY list_id) - 1 AS INTEGER) AS cell
       FROM ta{iters} GROUP BY list_id),
tops AS MATERIALIZED (SELECT cell, c FROM tn JOIN tc{iters} t ON t.list_id = top),
tx AS MATERIALIZED (SELECT gx.id, x, cell FROM gx JOIN ta{iters} a ON a.id = gx.id JOIN tn ON top = a.list_id),
sh AS (SELECT cell, share, sum(share) OVER (ORDER BY cell) - share AS base FROM (
  SELECT cell, least(greatest(1, n * {nlist} // (SELECT count(*) FROM gx)), {cell_lists}) AS share FROM tn)),
lc0 AS MATERIALIZED (SELECT cell, CAST(base + nth - 1 AS INTEGER) AS list_id, x AS c FROM (
  SELECT *, row_number() OVER (PARTITION BY cell ORDER BY id) AS nth FROM tx) JOIN sh USING (cell) WHERE nth <= share),""" \
        + _inner_rounds("lb", "lc", "tx", "JOIN {c} c ON c.cell = x.cell", iters, dim) + f"""
ls AS MATERIALIZED (SELECT * FROM lc{iters}),
la AS MATERIALIZED (SELECT * FROM lb{iters})"""


def tree_probe_ctes(nprobe: int, n_cells: int, every: int) -> str:
    """probes(qid, qn, list_id, coarse, probe_rank) of every ``every``-th vector."""
    return f""",
qc AS (SELECT id, x, cell FROM (SELECT gx.id, gx.x, cell, row_number() OVER (
         PARTITION BY gx.id ORDER BY list_dot_product(gx.x, c) DESC, cell) AS r
       FROM gx CROSS JOIN tops WHERE gx.id % {every} = 0) WHERE r <= {n_cells}),
probes AS (SELECT CAST(id AS VARCHAR) AS qid, id AS qn, list_id, coarse, CAST(probe_rank AS INTEGER) AS probe_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY coarse DESC, list_id) AS probe_rank FROM (
    SELECT qc.id, list_id, CAST(list_dot_product(qc.x, c) AS BIGINT) AS coarse FROM qc JOIN ls USING (cell)))
  WHERE probe_rank <= {nprobe})"""


def _with_cosine_lists() -> str:
    return "cs AS (" + emb_ctes(1, 1).split("cs AS (")[1]


def trained_codes_ctes(dim: int, pq_m: int, pq_bits: int, iters: int, lists_after: int) -> str:
    """Codebooks after ``iters`` unrolled rounds (bs: m, code, b on the grid), from the
    residuals to the lists of round ``lists_after``."""
    d, top = dim // pq_m, (1 << pq_bits) - 1
    out = f""",
sub AS MATERIALIZED (SELECT id, m, r[m * {d} + 1:(m + 1) * {d}]::DOUBLE[{d}] AS r FROM (
  SELECT gx.id, list_transform(list_zip(gx.x, c.c), lambda z: z[1] - z[2]) AS r,
         unnest(range(0, {pq_m})) AS m
  FROM gx JOIN a{lists_after} USING (id) JOIN c{lists_after} c USING (list_id))),
b0 AS MATERIALIZED (SELECT m, CAST(row_number() OVER (PARTITION BY m ORDER BY id) - 1 AS INTEGER) AS code, r AS b FROM sub
       QUALIFY row_number() OVER (PARTITION BY m ORDER BY id) <= {top + 1})"""
    for r in range(iters):
        means = _means(f"k{r} JOIN sub USING (id, m)", "m, code", "r::DOUBLE[]", d)
        out += f""",
k{r} AS MATERIALIZED (SELECT id, m, CAST({top} - (k & {top}) AS INTEGER) AS code FROM (
  SELECT id, m, max(CAST(2 * array_inner_product(r, b) - bb AS BIGINT) * {top + 1} + ({top} - code)) AS k
  FROM sub JOIN (SELECT *, array_inner_product(b, b) AS bb FROM b{r}) USING (m) GROUP BY id, m)),
b{r + 1} AS MATERIALIZED (SELECT o.m, o.code, coalesce(n.m_::DOUBLE[{d}], o.b) AS b FROM b{r} o LEFT JOIN (
  SELECT m, code, m_ FROM {means.replace(' AS m FROM', ' AS m_ FROM', 1)}) n ON n.m = o.m AND n.code = o.code)"""
    return out + f""",
bs AS MATERIALIZED (SELECT CAST(m AS INTEGER) AS m, code, list_transform(b::DOUBLE[], lambda x: x / s) AS b FROM b{iters}, gs)"""


def trained_pq_ctes(dim: int, pq_m: int, pq_bits: int, iters: int, lists_after: int) -> str:
    """The names of :func:`pq_ctes` with trained codebooks."""
    d = dim // pq_m
    given = pq_ctes(dim, pq_m, pq_bits)
    head, rest = given.split("seeds AS (")
    return trained_codes_ctes(dim, pq_m, pq_bits, iters, lists_after) + head + f"""
cb AS MATERIALIZED (SELECT m, code, unnest(range(0, {d})) AS t, unnest(b) AS cbv FROM bs),
dist AS (""" + rest.split("dist AS (")[1]


def probe_ctes(nprobe: int) -> str:
    return f""",
pr AS (SELECT CAST(id AS VARCHAR) AS qid, id AS qn, list_id, raw AS coarse,
              row_number() OVER (PARTITION BY id ORDER BY round(raw, 9) DESC, list_id) AS probe_rank
       FROM cs),
probes AS (SELECT * FROM pr WHERE probe_rank <= {nprobe})"""


def pq_ctes(dim: int, pq_m: int, pq_bits: int) -> str:
    dsub = dim // pq_m
    ksub = 1 << pq_bits
    return f""",
xs AS (SELECT id, unnest(range(0, {dim})) AS j, unnest(v) AS xv, n FROM u),
cx AS (SELECT list_id, unnest(range(0, {dim})) AS j, unnest(c) AS cv, cn FROM cent),
res AS (SELECT xs.id, a.list_id, xs.j, xs.xv / xs.n - cx.cv / cx.cn AS r
        FROM xs JOIN asg a ON a.id = xs.id JOIN cx ON cx.list_id = a.list_id AND cx.j = xs.j),
seeds AS (SELECT id, CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS code FROM train
          QUALIFY row_number() OVER (ORDER BY id) <= {ksub}),
cb AS (SELECT CAST(res.j // {dsub} AS INTEGER) AS m, seeds.code, res.j % {dsub} AS t, res.r AS cbv
       FROM res JOIN seeds ON seeds.id = res.id),
dist AS (SELECT res.id, CAST(res.j // {dsub} AS INTEGER) AS m, cb.code,
                sum((res.r - cb.cbv) * (res.r - cb.cbv)) AS d
         FROM res JOIN cb ON cb.m = res.j // {dsub} AND cb.t = res.j % {dsub} GROUP BY ALL),
codes AS (SELECT id, m, code FROM dist
          QUALIFY row_number() OVER (PARTITION BY id, m ORDER BY round(d, 9), code) = 1),
lut AS (SELECT xs.id AS qn, cb.m, cb.code, sum(xs.xv / xs.n * cb.cbv) AS l
        FROM xs JOIN cb ON cb.m = xs.j // {dsub} AND cb.t = xs.j % {dsub} GROUP BY ALL)"""


def exact_emb_ctes(metric: str, k: int) -> str:
    if metric == "cosine":
        score = "list_dot_product(q.v, x.v) / (q.n * x.n)"
        order = "score DESC, id"
    else:
        score = ("greatest(list_dot_product(q.v, q.v) + list_dot_product(x.v, x.v)"
                 " - 2 * list_dot_product(q.v, x.v), 0)")
        order = "score, id"
    return f""",
ex AS (SELECT CAST(q.id AS VARCHAR) AS qid, x.id, {score} AS score FROM u q CROSS JOIN u x),
exr AS (SELECT qid, id, score FROM ex
        QUALIFY row_number() OVER (PARTITION BY qid ORDER BY {order}) <= {k})"""


def rerank_ctes(k: int) -> str:
    """From cands: lexical overlap score and the reranked top-k (rr)."""
    return f""",
rpairs AS (SELECT k.qid, k.id, k.rank, qs.query, coalesce(c.text, '') AS text
          FROM cands k LEFT JOIN chunks c ON c.chunk_id = k.id JOIN qs ON qs.qid = k.qid),
rs AS (SELECT qid, id, rank AS retrieval_rank,
              CAST(len(list_intersect(list_distinct({tokens_sql('query')}),
                                      list_distinct({tokens_sql('text')}))) AS DOUBLE) AS score
       FROM rpairs),
rr AS (SELECT qid, id, retrieval_rank, score,
              row_number() OVER (PARTITION BY qid ORDER BY score DESC, retrieval_rank) AS rank
       FROM rs QUALIFY rank <= {k})"""


def bm25_ctes(k: int, k1: float, b: float) -> str:
    """From cands: BM25 within each query's candidates and the reranked top-k (rr)."""
    return f""",
bt AS MATERIALIZED (SELECT k.qid, k.id, k.rank, {tokens_sql("coalesce(c.text, '')")} AS t, list_distinct({tokens_sql('qs.query')}) AS q
       FROM cands k LEFT JOIN chunks c ON c.chunk_id = k.id JOIN qs ON qs.qid = k.qid),
bstat AS (SELECT qid, count(*) AS n, avg(len(t)) AS average FROM bt GROUP BY qid),
bterm AS (SELECT qid, id, rank, len(t) AS length, term, len(list_filter(t, lambda x: x = term)) AS tf
          FROM (SELECT *, unnest(q) AS term FROM bt)),
bdf AS (SELECT qid, term, count(*) AS df FROM bterm WHERE tf > 0 GROUP BY ALL),
bsum AS (SELECT t.qid, t.id, t.rank, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * {k1 + 1}
                / (tf + {k1} * ({1 - b} + {b} * length / average))) AS score
         FROM bterm t JOIN bdf USING (qid, term) JOIN bstat USING (qid) WHERE tf > 0 GROUP BY ALL),
rr AS (SELECT * FROM (SELECT bt.qid, bt.id, bt.rank AS retrieval_rank, round(coalesce(s.score, 0.0), 9) AS score,
              row_number() OVER (PARTITION BY bt.qid ORDER BY round(coalesce(s.score, 0.0), 9) DESC, bt.rank) AS rank
       FROM bt LEFT JOIN bsum s ON s.qid = bt.qid AND s.id = bt.id AND s.rank = bt.rank) WHERE rank <= {k})"""


def chunk_vector_ctes(dim: int, nlist: int) -> str:
    """Unit term-count vectors of all chunks (u) and the list count (nl), from sparse_ctes."""
    return f"""
u AS MATERIALIZED (SELECT id, v, sqrt(list_dot_product(v, v)) AS n FROM (
  SELECT g.id, list(coalesce(CAST(CAST(cb.n / sqrt(cn.ss::DOUBLE) AS FLOAT) AS DOUBLE), 0.0) ORDER BY g.j) AS v
  FROM (SELECT chunk_id AS id, unnest(range(0, {dim})) AS j FROM chunks) g
  LEFT JOIN cb ON cb.chunk_id = g.id AND cb.bucket = g.j LEFT JOIN cn ON cn.chunk_id = g.id GROUP BY g.id)),
nl AS (SELECT CASE WHEN count(*) < {nlist} THEN greatest(1, CAST(floor(count(*) / 8) AS INTEGER)) ELSE {nlist} END AS nlist
       FROM u),"""


def trained_search_ctes(dim: int, pq_m: int, pq_bits: int, nprobe: int, candidates: int) -> str:
    """cands(qid, id, score, rank) of the term-count queries over a trained index (cent,
    asg, bs)."""
    d, codes = dim // pq_m, 1 << pq_bits
    return f""",
books AS MATERIALIZED (SELECT m, code, b, array_inner_product(b, b) AS bb FROM (
  SELECT m, code, b::DOUBLE[{d}] AS b FROM bs)),
rl AS MATERIALIZED (SELECT id, m, r[m * {d} + 1:(m + 1) * {d}]::DOUBLE[{d}] AS r FROM (
  SELECT u.id, list_transform(list_zip(u.v, c.c), lambda z: z[1] / u.n - z[2] / c.cn) AS r, unnest(range(0, {pq_m})) AS m
  FROM u JOIN asg USING (id) JOIN cent c USING (list_id))),
cd AS MATERIALIZED (SELECT id, m, CAST(k % {codes} AS INTEGER) AS code FROM (
  SELECT id, m, min(CAST(round(greatest(array_inner_product(r, r) + bb - 2 * array_inner_product(r, b), 0), 9) * 1e9 AS BIGINT)
                    * {codes} + code) AS k FROM rl JOIN books USING (m) GROUP BY id, m)),
qd AS MATERIALIZED (SELECT qid, v, sqrt(list_dot_product(v, v)) AS n FROM (
  SELECT g.qid, list(CAST(coalesce(qb.n, 0) AS DOUBLE) ORDER BY g.j) AS v
  FROM (SELECT qid, unnest(range(0, {dim})) AS j FROM qs) g LEFT JOIN qb ON qb.qid = g.qid AND qb.bucket = g.j GROUP BY g.qid)),
pr AS (SELECT qid, list_id, list_dot_product(qd.v, cent.c) / (qd.n * cent.cn) AS coarse FROM qd CROSS JOIN cent
       QUALIFY row_number() OVER (PARTITION BY qid ORDER BY round(list_dot_product(qd.v, cent.c) / (qd.n * cent.cn), 9) DESC,
                                  list_id) <= {nprobe}),
lut AS MATERIALIZED (SELECT qid, m, code, array_inner_product(q, b) AS l FROM (
  SELECT qid, m, (list_transform(v, lambda x: x / n))[m * {d} + 1:(m + 1) * {d}]::DOUBLE[{d}] AS q
  FROM (SELECT *, unnest(range(0, {pq_m})) AS m FROM qd)) JOIN books USING (m)),
adc AS (SELECT pr.qid, asg.id, pr.coarse + sum(lut.l) AS score FROM pr JOIN asg USING (list_id) JOIN cd USING (id)
        JOIN lut ON lut.qid = pr.qid AND lut.m = cd.m AND lut.code = cd.code GROUP BY pr.qid, asg.id, pr.coarse),
cands AS (SELECT qid, id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM adc
          QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) <= {candidates})"""
