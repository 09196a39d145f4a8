"""DuckDB SQL equivalent to each registered query (the correctness oracle).

Views available: region nation customer supplier part orders lineitem
events documents embeddings pages benchmark labels conversations.  Column
names and types are aligned with the Spark results; doubles are rounded
the same way on both sides, iterated driver-side values are compared as
``%.9e`` strings.
"""

from __future__ import annotations

from tessera.functions.columns import FLOAT_PATTERN, SPECIAL_FLOAT_PATTERN
from tessera.functions.stopwords import ENGLISH_STOP_WORDS
from tessera.operators.logistic import random_start
from tessera.operators.clustering import MIXTURE_RIDGE
from tessera.plans import bindings as B

# ----------------------------------------------------------------------------- shared CTEs

TRIPS = """trips AS (
  SELECT l_suppkey AS medallion, l_partkey AS hack_license, l_quantity * 60 AS trip_time_in_secs,
         l_quantity AS trip_distance, l_extendedprice AS fare_amount, l_tax AS tolls_amount,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS total_amount
  FROM lineitem)"""


def _gt(c, v):
    return f"({c} IS NOT NULL AND NOT isnan({c}) AND {c} > {v})"


CLEAN = f"""clean AS (
  SELECT * FROM trips
  WHERE {_gt('trip_time_in_secs', 60)} AND {_gt('trip_distance', 0)} AND {_gt('fare_amount', 0)}
    AND {_gt('total_amount', 0)})"""

BOUNDED = f"""bounded AS (
  SELECT * FROM trips
  WHERE {_gt('trip_time_in_secs', 60)} AND {_gt('trip_distance', 0)} AND {_gt('fare_amount', B.FARE_LOW)}
    AND fare_amount < {B.FARE_HIGH} AND {_gt('total_amount', 0)} AND tolls_amount IS NOT NULL)"""

SIGMA = """sigma AS (
  SELECT * FROM bounded
  WHERE trip_distance >= (SELECT avg(trip_distance) - 3.0 * stddev_samp(trip_distance) FROM bounded)
    AND trip_distance <= (SELECT avg(trip_distance) + 3.0 * stddev_samp(trip_distance) FROM bounded))"""

TOKENS_EXPR = "list_filter(string_split_regex(lower(regexp_replace({t}, '[^a-zA-Z]', ' ', 'g')), ' +'), lambda w: w <> '')"


def _vocab_ctes(size: int, prefix: str = "", docs: str = "SELECT doc_id, text FROM documents") -> str:
    tok = TOKENS_EXPR.format(t="text")
    return f"""{prefix}docs AS ({docs}),
{prefix}toks AS (SELECT doc_id, {tok} AS words FROM {prefix}docs),
{prefix}occ AS (SELECT doc_id, unnest(words) AS word FROM {prefix}toks),
{prefix}wc AS (SELECT word, count(*) AS n FROM {prefix}occ GROUP BY word),
{prefix}vocab AS (
  SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, word) - 1 AS INTEGER) AS idx
  FROM {prefix}wc ORDER BY n DESC, word LIMIT {size}),
{prefix}terms AS (SELECT doc_id, idx, count(*) AS n FROM {prefix}occ JOIN {prefix}vocab USING (word) GROUP BY doc_id, idx),
{prefix}tf AS (SELECT doc_id, idx, n / sum(n) OVER (PARTITION BY doc_id) AS tf FROM {prefix}terms)"""


RETRIEVAL = _vocab_ctes(B.VOCAB_RETRIEVAL) + """,
dfreq AS (SELECT idx, count(*) AS df FROM terms GROUP BY idx),
idf AS (SELECT idx, ln((SELECT count(*) FROM documents) / (df + 1)) AS idf FROM dfreq),
dvec AS (SELECT doc_id, idx, tf * idf AS weight FROM tf JOIN idf USING (idx))"""

QVEC = """qtoks AS (SELECT item_id AS query_id, {tok} AS words FROM benchmark),
qocc AS (SELECT query_id, unnest(words) AS word FROM qtoks),
qterms AS (SELECT query_id, idx, count(*) AS n FROM qocc JOIN vocab USING (word) GROUP BY query_id, idx),
qtf AS (SELECT query_id, idx, n / sum(n) OVER (PARTITION BY query_id) AS tf FROM qterms),
qvec AS (SELECT query_id, idx, tf * idf AS weight FROM qtf JOIN idf USING (idx))""".format(tok=TOKENS_EXPR.format(t="text"))

KNN = f"""dn AS (SELECT doc_id, sqrt(sum(weight * weight)) AS norm FROM dvec GROUP BY doc_id),
qn AS (SELECT query_id, sqrt(sum(weight * weight)) AS norm FROM qvec GROUP BY query_id),
dots AS (SELECT query_id, doc_id, sum(q.weight * d.weight) AS dot FROM qvec q JOIN dvec d USING (idx) GROUP BY ALL),
cand AS (SELECT qn.query_id, dn.doc_id, coalesce(dots.dot, 0.0) AS dot, qn.norm AS qnorm, dn.norm AS dnorm
         FROM qn CROSS JOIN dn LEFT JOIN dots ON dots.query_id = qn.query_id AND dots.doc_id = dn.doc_id),
scored AS (SELECT query_id, doc_id,
                  round(CASE WHEN qnorm = 0 OR dnorm = 0 THEN 0.0 ELSE dot / (qnorm * dnorm) END, 10) AS score
           FROM cand),
topk AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                doc_id, score FROM scored QUALIFY rank <= {B.TOP_K})"""

DOC_LINES = """lines AS (SELECT '<doc id="' || CAST(doc_id AS VARCHAR) || '" url="' || source || '">' || text || '</doc>' AS value
                FROM documents),
parsed AS (
  SELECT substr(value, instr(value, 'id="') + 4, greatest(instr(value, '" url=') - (instr(value, 'id="') + 4), 0)) AS doc_id,
         substr(value, instr(value, '">') + 2) AS body
  FROM lines
  WHERE contains(value, 'id') AND contains(value, 'url=') AND instr(value, 'id="') > 0
    AND instr(value, '" url=') > 0 AND instr(value, '">') > 0),
docs_parsed AS (SELECT doc_id, substr(body, 1, greatest(length(body) - 6, 0)) AS text FROM parsed)"""


def _sql(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def _ok(x: str) -> str:
    s = f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    return (f"coalesce(regexp_matches({s}, '{FLOAT_PATTERN}') OR "
            f"regexp_matches(lower({s}), '{SPECIAL_FLOAT_PATTERN}'), false)")


PART_TEXT = """pt AS (SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, split_part(p_brand, '#', 2) AS brand_no,
                   p_type, CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice
            FROM part)"""
PART_TEXT_COLS = ["p_partkey", "p_name", "brand_no", "p_type", "p_size", "p_retailprice"]


def _site_label(col: str = "p_type") -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN {v}" for k, v in B.SITE_LABELS.items())
    return f"CASE {whens} END"


SITE = f"""site AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice,
                   CAST(split_part(p_brand, '#', 2) AS DOUBLE) AS brand_no, {_site_label()} AS label FROM part)"""

LINKS = """links AS (SELECT doc_id AS page, lang AS category FROM documents
                UNION ALL SELECT doc_id AS page, source AS category FROM documents)"""

ORDER_COUNTS = """counts AS (SELECT l_orderkey AS page, count(l_partkey) AS count FROM lineitem GROUP BY l_orderkey)"""


# ----------------------------------------------------------------------------- gradient descent

def gd_sql(xs: list[str], y: str, steps: int, rate: float, bold: bool, names: list[str],
           params: bool = True, points: tuple[str, ...] | None = None) -> str:
    """Recursive CTE over the one-row Gram statistics; same algebra and
    operation order as ``tessera.operators.linear.gd_history``."""
    p = len(xs)
    aggs = ["CAST(count(*) AS DOUBLE) AS n", f"avg({y}) AS my"]
    aggs += [f"avg({x}) AS mx{i}" for i, x in enumerate(xs)]
    for i in range(p):
        for j in range(i, p):
            aggs.append(f"covar_pop({xs[i]}, {xs[j]}) * count(*) AS c{i}_{j}")
        aggs.append(f"covar_pop({xs[i]}, {y}) * count(*) AS c{i}_y")
    aggs.append(f"var_pop({y}) * count(*) AS cyy")
    st = "st AS (SELECT " + ", ".join(aggs) + " FROM sigma)"

    def c(i, j):
        return f"c{min(i, j)}_{max(i, j)}"

    ms = [f"m{i}" for i in range(p)]
    ebar = "my - (" + " + ".join(f"{ms[i]} * mx{i}" for i in range(p)) + ") - b"
    quad = " + ".join(f"{ms[i]} * (" + " + ".join(f"{c(i, j)} * {ms[j]}" for j in range(p)) + ")" for i in range(p))
    sse = f"cyy - 2.0 * (" + " + ".join(f"{ms[i]} * c{i}_y" for i in range(p)) + f") + ({quad}) + n * ebar * ebar"
    sxe = [f"(c{i}_y - (" + " + ".join(f"{c(i, j)} * {ms[j]}" for j in range(p)) + f")) + mx{i} * n * ebar"
           for i in range(p)]
    init = ", ".join(["0"] + ["CAST(0.0 AS DOUBLE)"] * p + ["CAST(0.0 AS DOUBLE)", f"CAST({rate!r} AS DOUBLE)",
                                                           "CAST('inf' AS DOUBLE)", "CAST(NULL AS DOUBLE)"])
    new_ms = ", ".join(f"{ms[i]} - rate * (-2.0 / n * sxe{i})" for i in range(p))
    new_rate = "CASE WHEN sse < prev THEN rate * 1.05 ELSE rate * 0.5 END" if bold else "rate"
    new_prev = "sse" if bold else "prev"
    cols = ", ".join(["it"] + ms + ["b", "rate", "prev", "cost"])
    rec = f"""gd({cols}) AS (
  SELECT {init}
  UNION ALL
  SELECT it + 1, {new_ms}, b - rate * (-2.0 / n * (n * ebar)), {new_rate}, {new_prev}, sse
  FROM (SELECT q.*, {sse} AS sse, {", ".join(f"{e} AS sxe{i}" for i, e in enumerate(sxe))}
        FROM (SELECT g.*, s.*, {ebar} AS ebar FROM gd g, st s WHERE g.it < {steps}) q) r)"""
    outs = [f"printf('%.9e', cost) AS {names[1]}"]
    if params:
        outs += [f"printf('%.9e', {ms[i]}) AS {names[2 + i]}" for i in range(p)]
        outs += [f"printf('%.9e', b) AS {names[2 + p]}"]
    if not names[1]:        # no cost column
        outs = outs[1:]
    if names[-1] == "rate":
        outs += ["printf('%.9e', rate) AS rate"]
    return ("WITH RECURSIVE " + ",\n".join([*(points or (TRIPS, BOUNDED, SIGMA)), st, rec])
            + f"\nSELECT CAST(it AS INTEGER) AS {names[0]}, " + ", ".join(outs) + " FROM gd WHERE it > 0")


# ----------------------------------------------------------------------------- logistic regression

GD_POINTS = """sigma AS (
  SELECT day(l_shipdate) / CAST(10 AS DOUBLE) AS ship_day, l_quantity / CAST(10 AS DOUBLE) AS quantity,
         l_extendedprice / CAST(10000 AS DOUBLE) AS fare, l_tax AS tolls_amount,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) / CAST(10000 AS DOUBLE) AS total
  FROM lineitem WHERE l_shipdate IS NOT NULL AND l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL
    AND l_tax IS NOT NULL AND l_discount IS NOT NULL)"""


def _hex8(text: str) -> str:
    return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT)"


def _side(split: str) -> str:
    """Labelled documents of one side of the hash split."""
    return (f"SELECT d.doc_id, d.text, l.quality AS label FROM documents d JOIN labels l USING (doc_id) "
            f"WHERE {_hex8('CAST(d.doc_id AS VARCHAR)')} % 10 {'<' if split == 'train' else '>='} 7")


def _lr_base() -> list[str]:
    base = _vocab_ctes(B.VOCAB_LOGREG, docs=_side("train"))
    return [base,
            "lab AS (SELECT doc_id, label FROM docs)",
            "cwt AS (SELECT label, count(*) AS n FROM lab GROUP BY label)",
            "cw AS (SELECT label, CAST((SELECT sum(n) FROM cwt) AS DOUBLE) / (2.0 * n) AS w FROM cwt)",
            "feats AS (SELECT lab.doc_id, lab.label, tf.idx, tf.tf FROM lab JOIN tf USING (doc_id))",
            "dl AS (SELECT lab.doc_id, lab.label, cw.w AS cw FROM lab JOIN cw USING (label))"]


def _start_values() -> str:
    """The seeded start; the first values of the generator are the same for every vocabulary size."""
    w = random_start(B.VOCAB_LOGREG, B.LR_START_STD, B.LR_SEED)
    return "start(idx, w) AS (VALUES " + ", ".join(f"({i}, {float(v)!r})" for i, v in enumerate(w)) + ")"


def _lr_update(opt: str, t: int) -> str:
    """Per-idx update for step t (1-based); g is the regularised gradient."""
    lr, beta, beta2, eps = B.LR_RATE, 0.9, 0.999, 1e-7
    one_m_b, one_m_b2 = 1 - beta, 1 - beta2
    if opt == "SGD":
        return f"w - {lr!r} * g AS w, m, pm, v, gt"
    if opt == "Momentum":
        return f"w - ({beta!r} * m + {lr!r} * g) AS w, {beta!r} * m + {lr!r} * g AS m, pm, v, gt"
    if opt == "Nesterov":
        return f"(w - {beta!r} * pm) - {lr!r} * g AS w, {beta!r} * m + {lr!r} * g AS m, m AS pm, v, gt"
    if opt == "Adam":
        bc1, bc2 = 1 - beta ** t, 1 - beta2 ** t
        m_new = f"({beta!r} * m + {one_m_b!r} * g)"
        v_new = f"({beta2!r} * v + {one_m_b2!r} * (g * g))"
        return (f"w - {lr!r} * ({m_new} / {bc1!r}) / (sqrt({v_new} / {bc2!r}) + {eps!r}) AS w, "
                f"{m_new} AS m, pm, {v_new} AS v, gt")
    if opt == "Adagrad":
        return f"w - {lr!r} * (g / (sqrt(gt + g * g) + {eps!r})) AS w, m, pm, v, gt + g * g AS gt"
    if opt == "RMSprop":
        e = f"({beta!r} * gt / {t} + {one_m_b!r} * (g * g))"
        return f"w - {lr!r} / sqrt({e} + {eps!r}) * g AS w, m, pm, v, gt + g * g AS gt"
    raise ValueError(opt)


def lr_ctes(opt: str, steps: int = B.LR_STEPS, pre: str = "", random: bool = False, batch: int | None = None) -> list[str]:
    """The training run of one optimizer, a group of CTEs per step, over ``_lr_base``."""
    reg = B.LR_REG
    begin = "CAST(start.w AS DOUBLE)" if random else "CAST(0.0 AS DOUBLE)"
    second = "CAST((SELECT count(*) FROM vocab) AS DOUBLE)" if random else "CAST(0.0 AS DOUBLE)"
    ctes = [f"{pre}w0 AS MATERIALIZED (SELECT vocab.idx, {begin} AS w, CAST(0.0 AS DOUBLE) AS m, CAST(0.0 AS DOUBLE) AS pm, "
            f"{second} AS v, CAST(0.0 AS DOUBLE) AS gt FROM vocab" + (" JOIN start USING (idx))" if random else ")")]
    for t in range(1, steps + 1):
        p = t - 1
        rows = "dl"
        if batch:
            code = f"CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '-{t}'), 1, 15)) AS BIGINT)"
            all_ = "(SELECT count(*) FROM dl)"
            rows = f"(SELECT * FROM dl WHERE {batch} >= {all_} OR {code} < CAST({batch} AS HUGEINT) * {1 << 60} // {all_}) dl"
        ctes.append(f"""{pre}z{t} AS MATERIALIZED (
  SELECT dl.doc_id, dl.label, dl.cw, coalesce(sum(f.tf * w.w), 0.0) AS z
  FROM {rows} LEFT JOIN feats f USING (doc_id) LEFT JOIN {pre}w{p} w ON w.idx = f.idx GROUP BY ALL)""")
        ctes.append(f"{pre}n{t} AS MATERIALIZED (SELECT greatest(CAST(count(*) AS DOUBLE), 1.0) AS n FROM {pre}z{t})")
        ctes.append(f"""{pre}gs{t} AS MATERIALIZED (
  SELECT f.idx, sum(z.cw * f.tf * (1.0 / (1.0 + exp(-z.z)) - z.label)) AS gs
  FROM feats f JOIN {pre}z{t} z USING (doc_id) GROUP BY f.idx)""")
        ctes.append(f"""{pre}c{t} AS MATERIALIZED (
  SELECT {t} AS it, coalesce(sum(cw * ((greatest(z, 0.0) + ln(1.0 + exp(-abs(z)))) - label * z)), 0.0)
         / (SELECT n FROM {pre}n{t}) + {reg!r} * (SELECT sum(w * w) FROM {pre}w{p}) AS cost FROM {pre}z{t})""")
        ctes.append(f"""{pre}w{t} AS MATERIALIZED (
  SELECT idx, {_lr_update(opt, t)} FROM (
    SELECT w.idx, w.w, w.m, w.pm, w.v, w.gt,
           coalesce(gs.gs, 0.0) / (SELECT n FROM {pre}n{t}) + 2.0 * {reg!r} * w.w AS g
    FROM {pre}w{p} w LEFT JOIN {pre}gs{t} gs ON gs.idx = w.idx))""")
    ctes.append(f"{pre}hist AS (" + " UNION ALL ".join(f"SELECT it, cost FROM {pre}c{t}" for t in range(1, steps + 1)) + ")")
    ctes.append(f"{pre}flag AS (SELECT it, cost, abs(cost - coalesce(lag(cost) OVER (ORDER BY it), 0.0)) < 1e-07 AS stop "
                f"FROM {pre}hist)")
    ctes.append(f"{pre}stop_at AS (SELECT coalesce(min(it), {steps + 1}) AS s FROM {pre}flag WHERE stop)")
    ctes.append(f"{pre}wall AS (" + " UNION ALL ".join(f"SELECT {t} AS t, idx, w FROM {pre}w{t}"
                                                       for t in range(1, steps + 1)) + ")")
    ctes.append(f"{pre}wfinal AS (SELECT idx, w FROM {pre}wall WHERE t = (SELECT least(s, {steps}) FROM {pre}stop_at))")
    return ctes


def lr_history_sql(opt: str, steps: int = B.LR_STEPS, batch: int | None = None) -> str:
    return _sql(*_lr_base(), *lr_ctes(opt, steps, batch=batch), select="SELECT CAST(it AS INTEGER) AS iter, "
                "round(cost, 10) AS cost FROM flag WHERE it < (SELECT s FROM stop_at)")


def lr_compare_sql() -> str:
    runs = [(opt, f"{opt.lower()}_") for opt in B.LR_COMPARED]
    ctes = [c for opt, pre in runs for c in lr_ctes(opt, B.LR_COMPARE_STEPS, pre, random=True)]
    return _sql(*_lr_base(), _start_values(), *ctes, select="\nUNION ALL\n".join(
        f"SELECT '{opt}' AS optimizer, CAST(count(*) AS INTEGER) AS steps, round(arg_max(cost, it), 9) AS final_cost "
        f"FROM {pre}flag WHERE it < (SELECT s FROM {pre}stop_at)" for opt, pre in runs))


def _lr_predictions() -> list[str]:
    tok = TOKENS_EXPR.format(t="text")
    return [*_lr_base(), *lr_ctes("RMSprop"), f"tdocs AS ({_side('test')})",
            f"tocc AS (SELECT doc_id, unnest({tok}) AS word FROM tdocs)",
            "tterms AS (SELECT doc_id, idx, count(*) AS n FROM tocc JOIN vocab USING (word) GROUP BY doc_id, idx)",
            "ttf AS (SELECT doc_id, idx, n / sum(n) OVER (PARTITION BY doc_id) AS tf FROM tterms)",
            "tz AS (SELECT doc_id, sum(tf * w) AS z FROM ttf JOIN wfinal USING (idx) GROUP BY doc_id)",
            "pred AS (SELECT tdocs.doc_id, tdocs.label, CAST(coalesce(z, 0.0) > 0 AS INTEGER) AS prediction "
            "FROM tdocs LEFT JOIN tz USING (doc_id))"]


def lr_predict_sql() -> str:
    return _sql(*_lr_predictions(), select="SELECT doc_id, label, prediction FROM pred")


def lr_evaluate_sql() -> str:
    return _sql(*_lr_predictions(), select=_binary_metrics_sql("pred", "label", "prediction"))


def lr_top_weights_sql() -> str:
    return _sql(*_lr_base(), *lr_ctes("RMSprop"), select="""SELECT CAST(row_number() OVER (ORDER BY abs(weight) DESC, idx) AS INTEGER) AS rank,
  idx, word, weight FROM (SELECT w.idx, v.word, round(w.w, 10) AS weight FROM wfinal w LEFT JOIN vocab v USING (idx))
ORDER BY abs(weight) DESC, idx LIMIT 5""")


def lr_step_sql() -> str:
    first = lr_ctes("SGD", 1, random=True)
    return _sql(*_lr_base(), _start_values(), *first, select="""SELECT v.idx,
  round(coalesce(gs1.gs, 0.0) / (SELECT n FROM n1), 10) AS gradient FROM vocab v LEFT JOIN gs1 USING (idx)""")


def _binary_metrics_sql(table: str, label: str, pred: str) -> str:
    counts = ", ".join(f"CAST(count_if({label} = {a} AND {pred} = {b}) AS BIGINT) AS {n}"
                       for n, a, b in (("tp", 1, 1), ("fp", 0, 1), ("tn", 0, 0), ("fn", 1, 0)))
    return f"""SELECT tp, fp, tn, fn,
  round(CASE WHEN n = 0 THEN 0.0 ELSE CAST(tp + tn AS DOUBLE) / n END, 12) AS accuracy,
  round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END, 12) AS precision,
  round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END, 12) AS recall,
  round(CASE WHEN tp + 0.5 * (fp + fn) = 0 THEN 0.0 ELSE tp / (tp + 0.5 * (fp + fn)) END, 12) AS f1
FROM (SELECT {counts}, count(*) AS n FROM {table})"""


# ----------------------------------------------------------------------------- spark.ml text

ML_SPLIT = """mldocs AS (
  SELECT l.doc_id, l.quality AS label, d.text FROM labels l JOIN documents d USING (doc_id)
  WHERE CAST(('0x' || substr(md5(CAST(l.doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 10 < 7),
mltok AS (SELECT doc_id, label, string_split_regex(regexp_replace(lower(text), '\\s+$', ''), '\\s') AS words FROM mldocs),
mlocc AS (SELECT doc_id, label, unnest(words) AS token FROM mltok)"""


ML_ALL = ML_SPLIT[ML_SPLIT.index("mltok"):]
ML_ALL = "mldocs AS (SELECT doc_id, 0 AS label, text FROM documents),\n" + ML_ALL


def _stop_list() -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS)


ML_FILTERED = f"""mlkeep AS (SELECT doc_id, label, token FROM mlocc WHERE token NOT IN ({_stop_list()}))"""

CV = """cvstat AS (SELECT token AS term, count(*) AS tc, count(DISTINCT doc_id) AS df FROM mlkeep GROUP BY token),
cv AS (SELECT term, tc, df FROM cvstat WHERE df >= 10 AND df <= 5000 ORDER BY tc DESC, term LIMIT 5000)"""


CV_ALL = CV.replace("df >= 10 AND df <= 5000", f"df >= {B.ML_MIN_DF} AND df <= {B.ML_MAX_SHARE} * (SELECT count(*) FROM mldocs)")


CHI2 = """mm AS (SELECT count(*) AS m FROM mldocs),
labs AS (SELECT label, count(*) AS c FROM mldocs GROUP BY label),
mlc AS (SELECT k.doc_id, k.label, k.token AS term, count(*) AS cnt FROM mlkeep k JOIN cv ON cv.term = k.token GROUP BY ALL),
cat AS (SELECT mlc.term, mlc.label, CASE WHEN cv.df = (SELECT m FROM mm) THEN 0 ELSE mlc.cnt END AS v
        FROM mlc JOIN cv USING (term)),
present AS (SELECT term, label, count(*) AS k FROM cat WHERE v <> 0 GROUP BY ALL),
obs AS (SELECT term, v, label, count(*) AS o FROM cat WHERE v <> 0 GROUP BY ALL
        UNION ALL
        SELECT cv.term, 0 AS v, labs.label, labs.c - coalesce(present.k, 0) AS o
        FROM cv CROSS JOIN labs LEFT JOIN present ON present.term = cv.term AND present.label = labs.label),
cats AS (SELECT term, v FROM obs GROUP BY term, v HAVING sum(o) > 0),
cells AS (SELECT cats.term, cats.v, labs.label, labs.c, coalesce(obs.o, 0) AS o
          FROM cats CROSS JOIN labs LEFT JOIN obs ON obs.term = cats.term AND obs.v = cats.v AND obs.label = labs.label),
rt AS (SELECT term, v, sum(o) AS r FROM cells GROUP BY term, v),
chi AS (SELECT cells.term, count(DISTINCT cells.v) AS nv,
               CASE WHEN count(DISTINCT cells.v) <= 1 THEN 0.0 ELSE
               sum((cells.o - rt.r * cells.c / (SELECT m FROM mm)) * (cells.o - rt.r * cells.c / (SELECT m FROM mm))
                   / (rt.r * cells.c / (SELECT m FROM mm))) END AS statistic
        FROM cells JOIN rt ON rt.term = cells.term AND rt.v = cells.v GROUP BY cells.term)"""


# Logarithm of the chi-squared upper tail Q(a, x), a = dof / 2, x = statistic / 2: the lower function's series left of
# the mean, the upper one's continued fraction, from its far end, right of it.
CHI2_TAIL = """ax AS (SELECT chi.term, statistic, (nv - 1) * ((SELECT count(*) FROM labs) - 1) / 2.0 AS a, statistic / 2 AS x,
              row_number() OVER (ORDER BY cv.tc DESC, term) - 1 AS idx FROM chi JOIN cv USING (term)),
steps AS (SELECT *, 200 + CAST(floor(12 * sqrt(a)) AS INTEGER) AS n FROM ax),
tail AS (SELECT *, CASE WHEN a <= 0 OR x <= 0 THEN 0.0
  WHEN x < a + 1 THEN ln(1 - list_sum([exp((a + k) * ln(x) - x - lgamma(a + k + 1)) for k in range(0, n + 1)]))
  ELSE a * ln(x) - x - lgamma(a) - ln(list_reduce([x + 2 * n + 1 - a] || [CAST(k AS DOUBLE) for k in range(n, 0, -1)],
       lambda s, k: x + 2 * k - 1 - a - k * (k - a) / s)) END AS log_p FROM steps)"""


# ----------------------------------------------------------------------------- clustering

def _site_points() -> list[str]:
    """Complete rows of both splits."""
    code = _hex8("CAST(p_partkey AS VARCHAR)")
    return [SITE, f"""pts AS (SELECT p_partkey, p_size, p_retailprice, CASE WHEN {code} % 10 < 7 THEN 'train' ELSE 'test' END AS split
  FROM site WHERE p_size IS NOT NULL AND p_retailprice IS NOT NULL AND brand_no IS NOT NULL AND label IS NOT NULL)"""]


def _lloyd_ctes() -> list[str]:
    """Unrolled Lloyd steps per feature set, then the points of both splits with their cluster."""
    ctes = _site_points()
    finals = []
    for name, cols in B.SITE_FEATURES.items():
        dist = " + ".join(f"(p.{c} - c.{c}) * (p.{c} - c.{c})" for c in cols)
        ctes.append(f"""{name}_c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS INTEGER) AS i,
  {', '.join(cols)} FROM (SELECT * FROM pts WHERE split = 'train' ORDER BY p_partkey LIMIT {B.KMEANS_K}))""")
        for t in range(1, B.LLOYD_STEPS + 1):
            ctes.append(f"""{name}_c{t} AS MATERIALIZED (
  SELECT c.i, {', '.join(f'coalesce(m.{c}, c.{c}) AS {c}' for c in cols)} FROM {name}_c{t - 1} c LEFT JOIN (
    SELECT i, {', '.join(f'avg({c}) AS {c}' for c in cols)} FROM (
      SELECT {', '.join(f'p.{c}' for c in cols)}, c.i FROM pts p CROSS JOIN {name}_c{t - 1} c WHERE p.split = 'train'
      QUALIFY row_number() OVER (PARTITION BY p.p_partkey ORDER BY {dist}, c.i) = 1) GROUP BY i) m ON m.i = c.i)""")
        finals.append(f"""SELECT '{name}' AS features, split, p_partkey, p_size, p_retailprice, i AS prediction, [{', '.join(cols)}] AS x
  FROM (SELECT p.*, c.i FROM pts p CROSS JOIN {name}_c{B.LLOYD_STEPS} c
        QUALIFY row_number() OVER (PARTITION BY p.p_partkey ORDER BY {dist}, c.i) = 1)""")
    return ctes + ["fitted AS MATERIALIZED (" + " UNION ALL ".join(finals) + ")"]


def lloyd_points_sql() -> str:
    return _sql(*_lloyd_ctes(), select="SELECT features, split, p_partkey, p_size, p_retailprice, prediction FROM fitted")


def lloyd_quality_sql() -> str:
    return _sql(*_lloyd_ctes(), """pe AS (SELECT features, split, prediction, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM fitted),
cs AS (SELECT features, split, prediction, i, sum(v) AS s FROM pe GROUP BY ALL),
cl AS (SELECT features, split, prediction, list(s ORDER BY i) AS s FROM cs GROUP BY ALL),
cn AS (SELECT features, split, prediction, count(*) AS n, sum(list_dot_product(x, x)) AS q FROM fitted GROUP BY ALL),
stats AS (SELECT * FROM cl JOIN cn USING (features, split, prediction)),
d AS (SELECT p.features, p.split, p.p_partkey, p.prediction AS own, c.prediction AS cluster, c.n,
             list_dot_product(p.x, p.x) + c.q / c.n - 2.0 * list_dot_product(p.x, c.s) / c.n AS diss
      FROM fitted p JOIN stats c ON p.features = c.features AND p.split = c.split),
per AS (SELECT features, split, p_partkey, max(CASE WHEN cluster = own THEN diss * n / (n - 1) END) AS a,
               max(CASE WHEN cluster = own THEN n END) AS n_own, min(CASE WHEN cluster <> own THEN diss END) AS b
        FROM d GROUP BY ALL),
sil AS (SELECT features, split, round(avg(CASE WHEN n_own <= 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1
               ELSE 0.0 END), 8) AS silhouette FROM per GROUP BY ALL)""",
                select="""SELECT features, split, prediction AS cluster, min(p_retailprice) AS min_value, max(p_retailprice) AS max_value,
  round(avg(p_retailprice), 8) AS mean_value, round(stddev_samp(p_retailprice), 8) AS stddev_value, any_value(silhouette) AS silhouette
FROM fitted JOIN sil USING (features, split) GROUP BY features, split, prediction""")


def lloyd_sweep_sql() -> str:
    """Lloyd steps for every k together, and the silhouette of each."""
    cols = B.SITE_FEATURES["size_price"]
    names = ", ".join(cols)
    dist = " + ".join(f"(p.{c} - c.{c}) * (p.{c} - c.{c})" for c in cols)
    nearest = f"""SELECT {', '.join(f'p.{c}' for c in cols)}, p.p_partkey, c.k, c.i FROM pts p CROSS JOIN {{c}} c WHERE p.split = 'train'
      QUALIFY row_number() OVER (PARTITION BY p.p_partkey, c.k ORDER BY {dist}, c.i) = 1"""
    ctes = _site_points() + [f"""c0 AS MATERIALIZED (SELECT k, i, {names} FROM (SELECT unnest([{', '.join(map(str, B.SWEEP_KS))}]) AS k)
  JOIN (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS i, {names} FROM pts WHERE split = 'train') ON i < k)"""]
    for t in range(1, B.LLOYD_STEPS + 1):
        ctes.append(f"""c{t} AS MATERIALIZED (SELECT c.k, c.i, {', '.join(f'coalesce(m.{c}, c.{c}) AS {c}' for c in cols)}
  FROM c{t - 1} c LEFT JOIN (SELECT k, i, {', '.join(f'avg({c}) AS {c}' for c in cols)} FROM ({nearest.format(c=f'c{t - 1}')})
  GROUP BY k, i) m USING (k, i))""")
    return _sql(*ctes, f"fitted AS MATERIALIZED (SELECT k, p_partkey, i, [{names}] AS x FROM ({nearest.format(c=f'c{B.LLOYD_STEPS}')}))",
                """cs AS (SELECT k, i, list(s ORDER BY j) AS s FROM (SELECT k, i, j, sum(v) AS s FROM (
  SELECT k, i, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM fitted) GROUP BY ALL) GROUP BY ALL),
stats AS (SELECT * FROM cs JOIN (SELECT k, i, count(*) AS n, sum(list_dot_product(x, x)) AS q FROM fitted GROUP BY ALL) USING (k, i)),
d AS (SELECT p.k, p.p_partkey, p.i = c.i AS own, c.n, list_dot_product(p.x, p.x) + c.q / c.n - 2.0 * list_dot_product(p.x, c.s) / c.n AS far
      FROM fitted p JOIN stats c ON p.k = c.k),
per AS (SELECT k, p_partkey, max(CASE WHEN own THEN far * n / (n - 1) END) AS a, max(CASE WHEN own THEN n END) AS n_own,
               min(CASE WHEN NOT own THEN far END) AS b FROM d GROUP BY ALL)""",
                select="""SELECT k, round(avg(CASE WHEN n_own <= 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1
  ELSE 0.0 END), 8) AS silhouette FROM per GROUP BY k""")


def _mixture_ctes() -> list[str]:
    """Unrolled EM steps per feature set, in coordinates less the training mean: ``name_g<t>`` holds the components
    (i, w, m<a>, c<a><b>) after t steps, ``name_r<t>`` ln(weight x density) of every training row under them."""
    ctes = _site_points()
    for name, cols in B.SITE_FEATURES.items():
        d = range(len(cols))
        pairs = [(a, b) for a in d for b in d if b <= a]
        train = "FROM pts WHERE split = 'train'"
        ctes.append(f"{name}_y AS MATERIALIZED (SELECT p_partkey, split, "
                    + ", ".join(f"{c} - (SELECT avg({c}) {train}) AS y{a}" for a, c in enumerate(cols)) + " FROM pts)")
        start = ", ".join(f"(SELECT covar_pop({cols[a]}, {cols[b]}) {train}) {'+ %r' % MIXTURE_RIDGE if a == b else ''} AS c{a}{b}"
                          for a, b in pairs)
        ctes.append(f"""{name}_g0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS INTEGER) AS i,
  1.0 / {B.KMEANS_K} AS w, {', '.join(f'y{a} AS m{a}' for a in d)}, {start}
  FROM (SELECT * FROM {name}_y WHERE split = 'train' ORDER BY p_partkey LIMIT {B.KMEANS_K}))""")
        for t in range(B.MIXTURE_STEPS + 1):
            split = "WHERE y.split = 'train'" if t < B.MIXTURE_STEPS else ""
            off = [f"(y{a} - m{a})" for a in d]
            if len(cols) == 1:
                det, quad = "c00", f"{off[0]} * {off[0]} / c00"
            else:
                det = "(c00 * c11 - c10 * c10)"
                quad = (f"(c11 * {off[0]} * {off[0]} - 2 * c10 * {off[0]} * {off[1]} + c00 * {off[1]} * {off[1]}) / {det}")
            ctes.append(f"""{name}_r{t} AS MATERIALIZED (SELECT *, top + ln(sum(exp(l - top)) OVER (PARTITION BY p_partkey)) AS lse FROM (
  SELECT *, max(l) OVER (PARTITION BY p_partkey) AS top FROM (
  SELECT y.*, g.i, ln(w) - 0.5 * ({len(cols)} * ln(2 * pi()) + ln({det}) + {quad}) AS l FROM {name}_y y CROSS JOIN {name}_g{t} g {split})))""")
            if t < B.MIXTURE_STEPS:
                means = ", ".join(f"sum(exp(l - lse) * y{a}) / sum(exp(l - lse)) AS m{a}" for a in d)
                covs = ", ".join(f"sum(exp(l - lse) * y{a} * y{b}) / sum(exp(l - lse)) - sum(exp(l - lse) * y{a}) / sum(exp(l - lse)) "
                                 f"* sum(exp(l - lse) * y{b}) / sum(exp(l - lse)) {'+ %r' % MIXTURE_RIDGE if a == b else ''} AS c{a}{b}"
                                 for a, b in pairs)
                ctes.append(f"{name}_g{t + 1} AS MATERIALIZED (SELECT i, sum(exp(l - lse)) / count(*) AS w, {means}, {covs} "
                            f"FROM {name}_r{t} GROUP BY i)")
    return ctes


def mixture_history_sql() -> str:
    return _sql(*_mixture_ctes(), select="\nUNION ALL\n".join(
        f"SELECT '{name}' AS features, {t} AS step, format('{{:.9e}}', avg(lse)) AS mean_log_likelihood FROM {name}_r{t} WHERE i = 0"
        for name in B.SITE_FEATURES for t in range(B.MIXTURE_STEPS)))


def mixture_params_sql() -> str:
    fmt = "format('{:.9e}', "
    return _sql(*_mixture_ctes(), select="\nUNION ALL\n".join(
        f"SELECT '{name}' AS features, i AS component, '{c}' AS dim, {fmt}w) AS weight, {fmt}m{a} + (SELECT avg({c}) FROM pts "
        f"WHERE split = 'train')) AS mean, {fmt}c{a}{a}) AS variance FROM {name}_g{B.MIXTURE_STEPS}"
        for name, cols in B.SITE_FEATURES.items() for a, c in enumerate(cols)))


def mixture_points_sql() -> str:
    return _sql(*_mixture_ctes(), select="\nUNION ALL\n".join(
        f"SELECT '{name}' AS features, split, p_partkey, i AS prediction FROM {name}_r{B.MIXTURE_STEPS} "
        f"QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY l DESC, i) = 1" for name in B.SITE_FEATURES))


# ----------------------------------------------------------------------------- registry

def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_csv_inferred"] = ("SELECT CAST(p_partkey AS INTEGER) AS _c0, p_name AS _c1, p_brand AS _c2, p_type AS _c3, "
                              "p_size AS _c4, p_retailprice AS _c5 FROM part")
    q["scan_csv_schema"] = ("SELECT CAST(p_partkey AS INTEGER) AS partkey, p_name AS name, p_brand AS brand, "
                            "p_type AS type, p_size AS size, p_retailprice AS retailprice FROM part")
    q["scan_csv_corrupt"] = """WITH c AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 7 = 0 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS size,
  CASE WHEN p_partkey % 11 = 0 THEN '12,5' WHEN p_partkey % 17 = 0 THEN '' ELSE CAST(p_retailprice AS VARCHAR) END AS price FROM part)
SELECT CAST(k AS INTEGER) AS partkey, TRY_CAST(size AS INTEGER) AS size, CASE WHEN k % 11 = 0 THEN 12.0 ELSE TRY_CAST(nullif(price, '') AS DOUBLE) END AS price,
  CASE WHEN k % 11 = 0 THEN false WHEN k % 13 <> 0 THEN true END AS complete,
  CASE WHEN k % 7 = 0 OR (k % 11 = 0) = (k % 13 <> 0) THEN CAST(k AS VARCHAR) || ',' || size || ',' || price || CASE WHEN k % 13 = 0 THEN '' ELSE ',x' END END AS bad_line
FROM c"""
    q["scan_text_docs"] = _sql(DOC_LINES, select="SELECT CAST(doc_id AS VARCHAR) AS doc_id, "
                                                 "md5(text) AS text_md5 FROM docs_parsed")
    top_pairs = _sql(TRIPS, CLEAN, select=f"""SELECT medallion, count(*) AS n_drivers
FROM (SELECT DISTINCT medallion, hack_license FROM clean) GROUP BY medallion
ORDER BY n_drivers DESC, medallion LIMIT {B.TOP_K}""")
    q["sink_roundtrip"] = top_pairs
    q["doc_sample"] = f"SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT {B.TOP_K}"
    q["numeric_quality"] = _sql(PART_TEXT, select="\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST(count_if({_ok(c)}) AS BIGINT) AS n_valid, "
        f"CAST(count_if(NOT {_ok(c)}) AS BIGINT) AS n_invalid FROM pt" for c in PART_TEXT_COLS))
    q["line_arity"] = """SELECT doc_id, n_fields, n_fields = 3 AS arity_ok FROM (SELECT doc_id, CAST(len(string_split(
  concat_ws(',', CAST(doc_id AS VARCHAR), text, lang), ',')) AS INTEGER) AS n_fields FROM documents)"""
    trip_cols = "medallion, hack_license, trip_time_in_secs, trip_distance, fare_amount, tolls_amount, total_amount"
    q["clean_trips"] = _sql(TRIPS, CLEAN, select=f"SELECT {trip_cols} FROM clean")
    q["clean_trips_bounded"] = _sql(TRIPS, BOUNDED, select=f"SELECT {trip_cols} FROM bounded")
    q["sigma_filter"] = """WITH s AS (SELECT avg(n_chars) AS m, stddev_samp(n_chars) AS sd FROM documents)
SELECT doc_id, n_chars FROM documents, s WHERE n_chars >= m - 3.0 * sd AND n_chars <= m + 3.0 * sd"""
    q["site_clean"] = _sql(SITE, select="SELECT p_partkey, p_size, p_retailprice, brand_no, label FROM site "
                                        "WHERE p_size IS NOT NULL AND p_retailprice IS NOT NULL "
                                        "AND brand_no IS NOT NULL AND label IS NOT NULL")
    q["site_null_count"] = _sql(SITE, select="SELECT CAST(count_if(label IS NULL) AS BIGINT) AS n_null FROM site")
    q["label_from_prefix"] = (f"SELECT doc_id, CAST(coalesce(starts_with(source, '{B.SOURCE_PREFIX}'), false) AS INTEGER) "
                              "AS label FROM documents")
    q["parse_docs"] = _sql(DOC_LINES, select="SELECT doc_id, text FROM docs_parsed WHERE CAST(doc_id AS BIGINT) % 7 <> 0")
    q["parse_links"] = """WITH l AS (SELECT '"' || CAST(doc_id AS VARCHAR) || '","' || lang || '"' AS value FROM documents
  UNION ALL SELECT '"' || CAST(doc_id AS VARCHAR) || '","' || source || '"' AS value FROM documents)
SELECT replace(split_part(value, ',', 1), '"', '') AS page, replace(split_part(value, ',', 2), '"', '') AS category FROM l"""
    q["top_distinct_pairs"] = top_pairs
    q["top_mean_rate"] = _sql(TRIPS, CLEAN, select=f"""SELECT hack_license, mean_rate FROM (
  SELECT hack_license, round(avg(total_amount / (trip_time_in_secs / 60.0)), 6) AS mean_rate FROM clean GROUP BY hack_license)
ORDER BY mean_rate DESC, hack_license LIMIT {B.TOP_K}""")
    q["category_counts"] = _sql(ORDER_COUNTS, select="SELECT page, count FROM counts")
    q["category_stats"] = _sql(ORDER_COUNTS, select="SELECT max(count) AS max_value, round(avg(count), 10) AS mean_value, "
                                                    "round(stddev_samp(count), 10) AS stddev_value FROM counts")
    q["median_count"] = _sql(ORDER_COUNTS, select="SELECT quantile_disc(count, 0.5) AS median FROM counts")
    q["top_categories"] = f"""SELECT l_partkey AS category, count(l_orderkey) AS count FROM lineitem GROUP BY l_partkey
ORDER BY count DESC, category LIMIT {B.TOP_K}"""
    tok = TOKENS_EXPR.format(t="text")
    q["tokens"] = f"SELECT doc_id, CAST(len({tok}) AS BIGINT) AS n_tokens FROM documents"
    q["word_counts"] = _sql(_vocab_ctes(B.VOCAB_RETRIEVAL), select="SELECT word, n FROM wc")
    q["vocabulary"] = _sql(_vocab_ctes(B.VOCAB_RETRIEVAL), select="SELECT word, n, idx FROM vocab")
    probes = ", ".join(f"('{w}')" for w in B.PROBE_WORDS)
    q["word_lookup"] = _sql(_vocab_ctes(B.VOCAB_LOGREG), f"probe(word) AS (VALUES {probes})",
                            select="SELECT p.word, v.idx FROM probe p LEFT JOIN vocab v USING (word)")
    q["doc_terms"] = _sql(RETRIEVAL, select="SELECT doc_id, idx, n FROM terms")
    q["term_freq"] = _sql(RETRIEVAL, select="SELECT doc_id, idx, tf FROM tf")
    q["doc_freq"] = _sql(RETRIEVAL, select="SELECT idx, df FROM dfreq")
    q["idf"] = _sql(RETRIEVAL, select="SELECT idx, round(idf, 12) AS idf FROM idf")
    q["tfidf"] = _sql(RETRIEVAL, select="SELECT doc_id, idx, round(weight, 12) AS weight FROM dvec")
    q["query_vectors"] = _sql(RETRIEVAL, QVEC, select="SELECT query_id, idx, round(weight, 12) AS weight FROM qvec")
    q["knn_topk"] = _sql(RETRIEVAL, QVEC, KNN, select="SELECT query_id, rank, doc_id, score FROM topk")
    q["knn_vote"] = _sql(RETRIEVAL, QVEC, KNN, LINKS, select=f"""SELECT query_id, category, votes FROM (
  SELECT query_id, category, count(*) AS votes FROM topk JOIN links ON links.page = topk.doc_id GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, category) <= {B.TOP_K}""")
    short = QVEC.replace("SELECT item_id AS query_id,", "SELECT conv_id * 1000 + turn AS query_id,").replace(
        "FROM benchmark", "FROM conversations")
    q["knn_short"] = _sql(RETRIEVAL, short, KNN, select="SELECT query_id, rank, doc_id, score FROM topk")
    q["ols"] = _sql(TRIPS, BOUNDED, select="SELECT count(*) AS n, round(regr_slope(fare_amount, trip_distance), 6) AS slope, "
                                           "round(regr_intercept(fare_amount, trip_distance), 6) AS intercept FROM bounded")
    q["gd_line"] = gd_sql(["trip_distance"], "fare_amount", B.GD_STEPS_LINE, B.GD_RATE, False, ["iter", "cost", "m", "b"])
    multi = dict(xs=B.GD_MULTI_X, y="total", steps=B.GD_STEPS_MULTI, rate=B.GD_RATE, bold=True, points=(GD_POINTS,))
    q["gd_multi"] = gd_sql(**multi, names=["iter", "cost", "rate"], params=False)
    q["gd_multi_params"] = gd_sql(**multi, names=["iter", "", "m1", "m2", "m3", "m4", "b"])
    lr_base = _lr_base()
    q["labelled_features"] = _sql(*lr_base, select="SELECT doc_id, label, idx, tf FROM feats")
    q["class_weights"] = _sql(*lr_base, select="SELECT cwt.label, cwt.n, round(cw.w, 12) AS weight FROM cwt JOIN cw USING (label)")
    q["logreg_step"] = lr_step_sql()
    for key, opt in (("logreg_sgd", "SGD"), ("logreg_momentum", "Momentum"), ("logreg_nesterov", "Nesterov"),
                     ("logreg_adam", "Adam"), ("logreg_adagrad", "Adagrad"), ("logreg_rmsprop", "RMSprop")):
        q[key] = lr_history_sql(opt)
    q["logreg_predict"] = lr_predict_sql()
    q["top_weights"] = lr_top_weights_sql()
    q["logreg_minibatch"] = lr_history_sql("SGD", B.LR_COMPARE_STEPS, B.LR_BATCH)
    q["optimizer_costs"] = lr_compare_sql()
    q["logreg_evaluate"] = lr_evaluate_sql()
    q["binary_metrics"] = _binary_metrics_sql("labels", "quality", "toxic")
    q["weighted_metrics"] = """WITH cells AS (SELECT quality AS l, toxic AS p, count(*) AS n FROM labels GROUP BY ALL),
bl AS (SELECT l, sum(n) AS lab, coalesce(sum(CASE WHEN l = p THEN n END), 0) AS tp FROM cells GROUP BY l),
bp AS (SELECT p, sum(n) AS pred FROM cells GROUP BY p),
per AS (SELECT bl.lab, bl.tp, coalesce(bp.pred, 0) AS pred FROM bl LEFT JOIN bp ON bl.l = bp.p),
pr AS (SELECT lab, tp, CASE WHEN pred = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / pred END AS pc,
              CASE WHEN lab = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / lab END AS rc FROM per),
f AS (SELECT *, CASE WHEN pc + rc = 0 THEN 0.0 ELSE 2.0 * pc * rc / (pc + rc) END AS fc FROM pr)
SELECT round(sum(tp) / CAST(sum(lab) AS DOUBLE), 12) AS accuracy,
       round(sum(pc * lab) / CAST(sum(lab) AS DOUBLE), 12) AS weighted_precision,
       round(sum(rc * lab) / CAST(sum(lab) AS DOUBLE), 12) AS weighted_recall,
       round(sum(fc * lab) / CAST(sum(lab) AS DOUBLE), 12) AS weighted_f1 FROM f"""
    q["confusion_pivot"] = """SELECT quality AS label, CAST(count_if(toxic = 0) AS BIGINT) AS "0",
  CAST(count_if(toxic = 1) AS BIGINT) AS "1" FROM labels GROUP BY quality"""
    q["silhouette"] = """WITH pts AS (SELECT vec_id, label AS cluster, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
pe AS (SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM pts),
cs AS (SELECT cluster, i, sum(v) AS s FROM pe GROUP BY ALL),
cl AS (SELECT cluster, list(s ORDER BY i) AS s FROM cs GROUP BY cluster),
cn AS (SELECT cluster, count(*) AS n, sum(list_dot_product(x, x)) AS q FROM pts GROUP BY cluster),
stats AS (SELECT cluster, n, s, q FROM cl JOIN cn USING (cluster)),
d AS (SELECT p.vec_id, p.cluster AS own, c.cluster, c.n,
             list_dot_product(p.x, p.x) + c.q / c.n - 2.0 * list_dot_product(p.x, c.s) / c.n AS diss
      FROM pts p CROSS JOIN stats c),
per AS (SELECT vec_id, max(CASE WHEN cluster = own THEN diss * n / (n - 1) END) AS a,
               max(CASE WHEN cluster = own THEN n END) AS n_own, min(CASE WHEN cluster <> own THEN diss END) AS b
        FROM d GROUP BY vec_id),
s AS (SELECT CASE WHEN n_own <= 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END AS s FROM per)
SELECT round(avg(s), 10) AS silhouette FROM s"""
    q["cluster_summary"] = """WITH e AS (SELECT label AS cluster, CAST(unnest(embedding) AS DOUBLE) AS x,
  generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)
SELECT cluster, CAST(dim AS INTEGER) AS dim, min(x) AS min_value, max(x) AS max_value, round(avg(x), 10) AS mean_value,
  round(stddev_samp(x), 10) AS stddev_value FROM e GROUP BY cluster, dim"""
    q["lloyd_points"] = lloyd_points_sql()
    q["lloyd_quality"] = lloyd_quality_sql()
    q["lloyd_sweep"] = lloyd_sweep_sql()
    q["mixture_history"] = mixture_history_sql()
    q["mixture_params"] = mixture_params_sql()
    q["mixture_points"] = mixture_points_sql()
    q["kmeans_assign"] = f"""WITH pts AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
cen AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS i, x AS c FROM pts ORDER BY vec_id LIMIT {B.KMEANS_K}),
dist AS (SELECT p.vec_id, c.i, list_sum(list_transform(list_zip(p.x, c.c), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) AS d
         FROM pts p CROSS JOIN cen c)
SELECT vec_id, i AS prediction FROM dist QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, i) = 1"""
    q["split_hash"] = """SELECT p_partkey, CASE WHEN CAST(('0x' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8)) AS BIGINT) % 10 < 7
  THEN 'train' ELSE 'test' END AS split FROM part"""
    q["ml_tokens"] = _sql(ML_ALL, select="SELECT token, count(*) AS n FROM mlocc GROUP BY token")
    q["ml_stopwords"] = _sql(ML_ALL, ML_FILTERED, select="SELECT token, count(*) AS n FROM mlkeep GROUP BY token")
    q["ml_idf"] = _sql(ML_ALL, ML_FILTERED, CV_ALL, select="""SELECT term,
  round(ln((CAST((SELECT count(*) FROM mldocs) AS DOUBLE) + 1.0) / (df + 1.0)), 12) AS idf FROM cv""")
    q["cv_vocabulary"] = _sql(ML_ALL, ML_FILTERED, CV_ALL, select="""SELECT
  CAST(row_number() OVER (ORDER BY tc DESC, term) - 1 AS INTEGER) AS idx, term, tc AS n, df FROM cv""")
    q["chi2_selected"] = _sql(ML_SPLIT, ML_FILTERED, CV, CHI2, CHI2_TAIL, select=f"""SELECT
  CAST(rank AS INTEGER) AS rank, term, round(statistic, 8) AS statistic, CAST(2 * a AS INTEGER) AS dof
FROM (SELECT *, row_number() OVER (ORDER BY round(log_p, 8), idx) AS rank FROM tail) WHERE rank <= {B.ML_SELECTED}""")
    rows = """(SELECT count(*) FROM ok) AS n_train, (SELECT count(*) FROM labels JOIN documents USING (doc_id)) - (SELECT count(*) FROM ok) AS n_test"""
    q["ml_fit_check"] = _sql(ML_SPLIT, "ok AS (SELECT doc_id FROM mldocs)", select="\nUNION ALL\n".join(
        f"SELECT '{kind}' AS model, {n} AS n_features, {rows}, true AS objective_matches, true AS gradient_small, CAST(0 AS BIGINT) AS mismatches"
        for kind in ("logreg", "svm") for n in (5000, B.ML_SELECTED)))
    q["site_fit_check"] = _sql(*_site_points(), select="\nUNION ALL\n".join(
        f"SELECT '{name}' AS model, count_if(split = 'train') AS n_train, count_if(split = 'test') AS n_test, true AS sound, "
        f"CAST(0 AS BIGINT) AS mismatches FROM pts" for name in ("logistic_regression", "random_forest")))
    q["chi2_stats"] = _sql(ML_SPLIT, ML_FILTERED, CV, CHI2, select="""SELECT term, round(statistic, 8) AS statistic,
  CAST((nv - 1) * ((SELECT count(*) FROM labs) - 1) AS INTEGER) AS dof FROM chi""")
    return q
