"""The same results in DuckDB SQL, over the same whole tables.

Written independently of the Spark plans: plain global windows, cross joins and lists, which
are fine on one small machine and say what the distributed plans must equal.
"""

from __future__ import annotations

from wordloom.functions.text import SPACE, WORD
from wordloom.params import CONVERSATIONAL, DEFAULT, TECHNICAL, TrainingPlan

PLAN = TrainingPlan()
L, W, CAP, EPOCH = 64, 16, 2000, 200

# ── shared pieces ────────────────────────────────────────────────────────────────────────


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def simple_tokens(col: str) -> str:
    return f"regexp_extract_all(lower({col}), '[{WORD}\\-]+|[.,!?;:]')"


def split_tokens(text: str, isolated: str, keep) -> str:
    spaced = f"regexp_replace({text}, {q(isolated)}, ' \\1 ', 'g')"
    kept = ", ".join(q(k) for k in keep)
    return (
        f"list_filter(regexp_split_to_array({spaced}, {q('[' + SPACE + ']+')}), "
        f"lambda x: regexp_full_match(x, '[{WORD}\\-]+') OR x IN ({kept}))"
    )


CONV = split_tokens("lower(text)", rf"([^{WORD}{SPACE}\-'])", CONVERSATIONAL.keep_punctuation)
TECH = split_tokens("strip_accents(text)", rf"([^{WORD}{SPACE}\-_.])", TECHNICAL.keep_punctuation)

TURNS = "turns AS (SELECT conv_id * 1048576 + turn AS ex_id, conv_id, turn, role, text FROM conversations)"
PAIRS = f"""{TURNS},
pairs AS (SELECT u.ex_id, u.conv_id, u.text AS prompt, a.text AS response FROM turns u
  JOIN turns a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant')"""


def corpus(source: str, key: str, toks: str, suffix: str = "") -> str:
    """tl: token lists; tok: one row per token; wc: counts with first occurrence."""
    s = suffix
    return f"""tl{s} AS (SELECT {key} AS k, {toks} AS t FROM {source}),
tok{s} AS (SELECT k, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos FROM tl{s}),
wc{s} AS (SELECT token, count(*) AS n, min(k::HUGEINT * 4294967296 + pos) AS first FROM tok{s} GROUP BY token)"""


DOCS = corpus("documents", "doc_id", simple_tokens("text"))
SPECIAL = "SELECT * FROM (VALUES (0, '<PAD>', 0), (1, '<UNK>', 0), (2, '<SOS>', 0), (3, '<EOS>', 0)) s(id, token, n)"
VOCAB = f"""words AS (SELECT 3 + row_number() OVER (ORDER BY first) AS id, token, n FROM wc WHERE n >= {DEFAULT.min_frequency}),
vocab AS (SELECT * FROM words UNION ALL {SPECIAL})"""
CODED = """coded AS (SELECT tok.k, tok.pos, tok.token, coalesce(words.id, 1) AS id FROM tok LEFT JOIN words USING (token)),
packed AS (SELECT k, list(id ORDER BY pos) AS ids FROM coded GROUP BY k),
enc AS (SELECT tl.k, coalesce(packed.ids, []::BIGINT[]) AS ids FROM tl LEFT JOIN packed USING (k))"""
DOC_ENC = f"WITH {DOCS}, {VOCAB}, {CODED}"
CONVO = corpus("turns", "ex_id", simple_tokens("text"))


def fit(ids: str, length: int) -> str:
    cut = f"({ids})[1:{length}]"
    return f"list_concat({cut}, list_resize([]::BIGINT[], {length} - len({cut}), 0::BIGINT))"


def show(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"


WINDOWS = f"""win AS (SELECT k AS doc_id, start, ids[start + 1 : start + {W}] AS src, ids[start + {W} + 1 : start + {2 * W}] AS tgt
  FROM (SELECT k, ids, unnest(range(0, len(ids) - {2 * W}, {W})) AS start FROM enc))"""

# Pairs against the vocabulary of all turns.
SIDES = """sides AS (SELECT ex_id, 's' AS side, prompt AS text FROM pairs UNION ALL SELECT ex_id, 'r', response FROM pairs)"""
PAIR_IDS = f"""WITH {PAIRS}, {CONVO}, {VOCAB}, {SIDES},
st AS (SELECT ex_id, side, {simple_tokens("text")} AS t FROM sides),
se AS (SELECT ex_id, side, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM st),
sc AS (SELECT ex_id, side, list(coalesce(w.id, 1) ORDER BY pos) AS ids FROM se LEFT JOIN words w USING (token) GROUP BY ALL),
p AS (SELECT a.ex_id, {fit("a.ids", L)} AS src, {fit("b.ids", L - 1)} AS tgt FROM sc a JOIN sc b USING (ex_id) WHERE a.side = 's' AND b.side = 'r')"""

STEPS = f"""ev AS (SELECT user_id % 10 AS run_id, event_id, floor(value * 64) / 64.0::DOUBLE AS loss,
  floor(value * 6.4::DOUBLE) / 64.0::DOUBLE AS grad_norm,
  least(1.0::DOUBLE, ((props->>'$.k')::BIGINT + (user_id % 10) * 10 + 100) / 256.0::DOUBLE) AS accuracy,
  epoch_us(ts) AS micros FROM events),
steps AS (SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY event_id) AS step,
  (row_number() OVER (PARTITION BY run_id ORDER BY event_id) - 1) // {EPOCH} AS epoch, loss, grad_norm, accuracy, micros, event_id FROM ev)"""


def noise(order: str) -> str:
    return f"""CASE WHEN {order} % 97 = 0 THEN 'NaN'::DOUBLE WHEN {order} % 211 = 0 THEN 'Infinity'::DOUBLE ELSE loss END AS loss,
  CASE WHEN {order} % 89 = 0 THEN 'NaN'::DOUBLE WHEN run_id % 3 = 0 AND {order} % 4 <> 0 THEN 0.0 ELSE grad_norm END AS grad_norm"""


NOISY = f"""{STEPS},
ns AS (SELECT run_id, step, epoch, accuracy, event_id, {noise("step")} FROM steps)"""

VAL = """val AS (SELECT run_id, epoch, max(step) AS step, avg(loss) AS val_loss, avg(loss) * run_id / 90.0::DOUBLE AS attn_entropy,
  avg(loss) / 4.0::DOUBLE AS memory_gb FROM steps GROUP BY run_id, epoch)"""

# The windows of the health checks, over steps `ns` with an order column `step`.
LOSS_WIN = """lk AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step) AS i FROM ns WHERE isfinite(loss)),
lw AS (SELECT run_id, step, list(loss) OVER (PARTITION BY run_id ORDER BY i ROWS 99 PRECEDING) AS a FROM lk),
ls AS (SELECT run_id, step, len(a) AS n_loss, list_avg(a[1 : len(a) // 2]) AS loss_older, list_avg(a[len(a) // 2 + 1 :]) AS loss_newer,
  list_avg(a[1:15]) AS loss_early, list_avg(a[-15:]) AS loss_late, list_avg(a[-20:]) AS loss_recent, list_avg(a) AS avg_loss FROM lw),
lf AS (SELECT ns.run_id, ns.step, ls.* EXCLUDE (run_id, step) FROM ns ASOF LEFT JOIN ls ON ns.run_id = ls.run_id AND ns.step >= ls.step)"""
GRAD_WIN = """gk AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step) AS i FROM ns WHERE NOT isnan(grad_norm)),
gw AS (SELECT run_id, step, list(grad_norm) OVER (PARTITION BY run_id ORDER BY i ROWS 99 PRECEDING) AS a FROM gk),
gs AS (SELECT run_id, step, len(a) AS n_grad, len(list_filter(a[-20:], lambda x: x > 10)) / len(a[-20:])::DOUBLE AS high,
  len(list_filter(a[-20:], lambda x: x < 1e-4)) / len(a[-20:])::DOUBLE AS low, list_max(a[-20:]) AS recent_max,
  list_avg(a) AS avg_grad, list_max(a) AS max_grad, list_min(a) AS min_grad FROM gw),
gf AS (SELECT ns.run_id, ns.step, gs.* EXCLUDE (run_id, step) FROM ns ASOF LEFT JOIN gs ON ns.run_id = gs.run_id AND ns.step >= gs.step)"""
STEP_WIN = """sw AS (SELECT run_id, step, loss, accuracy, list(accuracy) OVER w AS a,
  list(CASE WHEN isnan(loss) THEN 0.0 ELSE loss END) OVER w AS p FROM ns
  WINDOW w AS (PARTITION BY run_id ORDER BY step ROWS 99 PRECEDING)),
sf AS (SELECT run_id, step, len(a) AS n_acc, list_avg(a[1 : len(a) // 2]) AS acc_older, list_avg(a[len(a) // 2 + 1 :]) AS acc_newer,
  list_avg(a) AS avg_accuracy, list_avg(a[-60:-31]) AS pa, list_avg(a[-30:]) AS pb, list_avg(p[-60:-31]) AS la, list_avg(p[-30:]) AS lb,
  list_avg(a[-30:]) AS acc_recent FROM sw)"""

GRAD_FLAGS = """coalesce(step >= 30 AND n_grad >= 20 AND high > 0.3::DOUBLE, false) AS gradient_explosion,
  coalesce(step >= 30 AND n_grad >= 20 AND high <= 0.3::DOUBLE AND recent_max > 20, false) AS gradient_spike,
  coalesce(step >= 30 AND n_grad >= 20 AND low > 0.5::DOUBLE, false) AS gradient_vanishing"""
GAIN = "CASE WHEN loss_older > 0 THEN (loss_older - loss_newer) / loss_older ELSE 0 END"
PLATEAU = f"coalesce(step >= 30 AND n_loss >= 50 AND {GAIN} >= 0 AND {GAIN} < 0.002::DOUBLE, false) AS loss_plateau"
ACC_FLAGS = """coalesce(step >= 30 AND n_acc >= 80 AND acc_newer - acc_older >= 0 AND acc_newer - acc_older < 0.001::DOUBLE, false) AS accuracy_stall,
  coalesce(step >= 30 AND n_acc >= 80 AND acc_newer - acc_older < -0.01::DOUBLE, false) AS accuracy_degrading"""
PAIR_GAIN = "CASE WHEN la > 0 THEN (la - lb) / la ELSE 0 END"
CONF_FLAGS = f"""(step >= 30 AND n_acc >= 60 AND pb > 0.85::DOUBLE AND {PAIR_GAIN} < 0.005::DOUBLE) AS overconfidence_high_acc,
  (step >= 30 AND n_acc >= 60 AND pb > pa + 0.005::DOUBLE AND lb > la * 1.01::DOUBLE) AS overconfidence_divergence,
  (step >= 30 AND n_acc >= 60 AND step < 500 AND pb > 0.90::DOUBLE) AS overconfidence_early"""
DIV_FLAGS = """coalesce(step >= 30 AND n_loss >= 10 AND NOT isfinite(loss), false) AS nan_loss_critical,
  coalesce(step >= 30 AND n_loss >= 10 AND isfinite(loss) AND loss_recent > 0 AND loss > loss_recent * 3, false) AS loss_spike"""


def health(steps: str, val: str) -> str:
    """Health of every step; `steps` defines ns, `val` gives val_loss as a scalar expression."""
    return f"""WITH {steps}, {LOSS_WIN}, {GRAD_WIN}, {STEP_WIN},
f AS (SELECT ns.*, {val} AS val_loss, lf.* EXCLUDE (run_id, step), gf.* EXCLUDE (run_id, step), sf.* EXCLUDE (run_id, step),
  count(*) FILTER (NOT isfinite(ns.loss)) OVER (PARTITION BY ns.run_id ORDER BY ns.step) AS nan_count
  FROM ns JOIN lf USING (run_id, step) JOIN gf USING (run_id, step) JOIN sf USING (run_id, step)),
c AS (SELECT run_id, step, event_id, nan_count, {GRAD_FLAGS}, {PLATEAU}, {ACC_FLAGS}, {CONF_FLAGS}, {DIV_FLAGS},
  coalesce(step >= 30 AND val_loss > loss * 1.15::DOUBLE AND accuracy > 0.4::DOUBLE, false) AS overfit FROM f),
h AS (SELECT run_id, step, event_id, nan_count, CASE WHEN step < 30 THEN 'warmup' WHEN nan_count > 5 OR nan_loss_critical THEN 'critical'
  WHEN gradient_explosion OR gradient_spike OR gradient_vanishing OR loss_plateau OR accuracy_stall OR accuracy_degrading
    OR overconfidence_high_acc OR overconfidence_divergence OR overconfidence_early OR loss_spike OR overfit THEN 'warning'
  ELSE 'healthy' END AS health FROM c)"""


def tuned(steps: str, val: str) -> str:
    """The adjustment log `r`, as a fold of the flagged steps of each run, one step at a time."""
    changed = lambda value, now: f"CASE WHEN {value} <> {now} THEN {value} END"
    rounded = lambda value: f"format('{{:.4f}}', {value})::DOUBLE"
    up = {"overconfidence_high_acc": 0.025, "overconfidence_divergence": 0.03, "overconfidence_early": 0.04}
    smooth = [changed(f"least(smoothing + {d}::DOUBLE, 0.3::DOUBLE)", "smoothing") for d in up.values()]
    checks = (
        "gradient_explosion gradient_spike gradient_vanishing loss_plateau accuracy_stall accuracy_degrading "
        "overconfidence_high_acc overconfidence_divergence overconfidence_early nan_loss_critical loss_spike sft_overfitting"
    ).split()
    told = ", ".join(f"CASE WHEN {c} THEN '{c}' END" for c in checks)
    return f"""{health(steps, val).replace("WITH ", "WITH RECURSIVE ", 1)},
fl AS (SELECT * RENAME (overfit AS sft_overfitting), row_number() OVER (PARTITION BY run_id ORDER BY step) AS i FROM c
  WHERE gradient_explosion OR gradient_spike OR gradient_vanishing OR loss_plateau OR accuracy_stall OR accuracy_degrading
    OR overconfidence_high_acc OR overconfidence_divergence OR overconfidence_early OR nan_loss_critical OR loss_spike OR overfit),
r0 AS (SELECT run_id, 0::BIGINT AS i, 0::BIGINT AS step, '' AS reasons, false AS adjusted, {PLAN.grad_clip}::DOUBLE AS clip, 1.0::DOUBLE AS scale,
  {PLAN.label_smoothing}::DOUBLE AS smoothing, {PLAN.dropout}::DOUBLE AS dropout, -200::BIGINT AS last, 0::BIGINT AS adjustments FROM fl WHERE i = 1),
r AS (SELECT * FROM r0 UNION ALL
  SELECT run_id, i, step, reasons, go, CASE WHEN go THEN coalesce({rounded("new_clip")}, clip) ELSE clip END,
    CASE WHEN go THEN coalesce({rounded("new_scale")}, scale) ELSE scale END,
    CASE WHEN go THEN coalesce({rounded("new_smoothing")}, smoothing) ELSE smoothing END,
    CASE WHEN go THEN coalesce({rounded("new_dropout")}, dropout) ELSE dropout END,
    CASE WHEN go THEN step ELSE last END, adjustments + go::BIGINT
  FROM (SELECT *, concat_ws(' ', {told}) AS reasons,
      coalesce(new_clip, new_scale, new_smoothing, new_dropout) IS NOT NULL AND (step - last >= 200 OR nan_loss_critical OR loss_spike) AS go
    FROM (SELECT * REPLACE (found_2 AS overconfidence_divergence, found_3 AS overconfidence_early),
        coalesce(CASE WHEN found_3 THEN {smooth[2]} END, CASE WHEN found_2 THEN {smooth[1]} END, CASE WHEN overconfidence_high_acc THEN {smooth[0]} END,
          CASE WHEN accuracy_stall THEN {changed("greatest(smoothing - 0.02::DOUBLE, 0.0::DOUBLE)", "smoothing")} END) AS new_smoothing,
        coalesce(CASE WHEN nan_loss_critical THEN greatest(clip * 0.5::DOUBLE, 0.1::DOUBLE) END,
          CASE WHEN gradient_vanishing THEN {changed("least(clip * 1.2::DOUBLE, 10.0::DOUBLE)", "clip")} END,
          CASE WHEN gradient_spike THEN greatest(clip * 0.9::DOUBLE, 0.1::DOUBLE) END,
          CASE WHEN gradient_explosion THEN {changed("greatest(clip * 0.8::DOUBLE, 0.1::DOUBLE)", "clip")} END) AS new_clip,
        coalesce(CASE WHEN loss_spike THEN greatest(scale * 0.7::DOUBLE, 0.1::DOUBLE) END, CASE WHEN nan_loss_critical THEN greatest(scale * 0.5::DOUBLE, 0.05::DOUBLE) END,
          CASE WHEN gradient_vanishing THEN {changed("least(scale * 1.15::DOUBLE, 3.0::DOUBLE)", "scale")} END,
          CASE WHEN gradient_explosion THEN {changed("greatest(scale * 0.85::DOUBLE, 0.1::DOUBLE)", "scale")} END,
          CASE WHEN loss_plateau THEN {changed("least(scale * 1.1::DOUBLE, 3.0::DOUBLE)", "scale")} END,
          CASE WHEN accuracy_degrading THEN {changed("greatest(scale * 0.9::DOUBLE, 0.1::DOUBLE)", "scale")} END) AS new_scale,
        CASE WHEN sft_overfitting THEN {changed("least(dropout + 0.05::DOUBLE, 0.5::DOUBLE)", "dropout")} END AS new_dropout
      FROM (SELECT *, overconfidence_divergence AND NOT (overconfidence_high_acc AND smoothing < 0.3::DOUBLE) AS found_2,
          overconfidence_early AND NOT ((overconfidence_high_acc OR overconfidence_divergence) AND smoothing < 0.3::DOUBLE) AS found_3
        FROM (SELECT fl.*, r.clip, r.scale, r.smoothing, r.dropout, r.last, r.adjustments FROM r JOIN fl ON fl.run_id = r.run_id AND fl.i = r.i + 1)))))"""


KNOWN_VAL = "(SELECT max_by(v.val_loss, v.step) FROM val v WHERE v.run_id = ns.run_id AND v.step < ns.step)"
RISK = """CASE WHEN n_acc < 30 THEN 0.0 ELSE least(greatest(0, acc_recent - 0.5::DOUBLE) / 0.5::DOUBLE * CASE WHEN n_loss >= 30 AND loss_early > 0
  THEN greatest(0, 1 - (loss_early - loss_late) / loss_early) ELSE 0 END, 1) END"""
TUNED = tuned(NOISY + ", " + VAL, KNOWN_VAL)
VEC = """x AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings),
s AS (SELECT vec_id, v, label, list_max(v) + ln(list_sum(list_transform(v, lambda e: exp(e - list_max(v))))) AS lse FROM x)"""
ATTN = f"""{VEC},
att AS (SELECT vec_id // 256 AS item, (label % 2)::BIGINT AS layer, vec_id % 8 AS head, (vec_id // 8) % 32 AS row,
  list_transform(v, lambda e: exp(e - lse)) AS w FROM s)"""
KNN = """u AS (SELECT vec_id AS id, list_transform(embedding::DOUBLE[], lambda e: e / greatest(sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda z: z * z))), 1e-8)) AS v FROM embeddings),
near AS (SELECT a.id, b.id AS neighbour, list_dot_product(a.v, b.v) AS sim FROM u a JOIN u b ON a.id <> b.id),
knn AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sim DESC, neighbour) AS rank FROM near QUALIFY rank <= 3)"""
LR = f"""CASE WHEN step < {PLAN.warmup_steps} THEN {PLAN.max_lr}::DOUBLE * (step / {PLAN.warmup_steps}::DOUBLE)
  ELSE {PLAN.min_lr}::DOUBLE + ({PLAN.max_lr}::DOUBLE - {PLAN.min_lr}::DOUBLE) * 0.5::DOUBLE * (1 + cos(pi() * least((step - {PLAN.warmup_steps}) / {2000 - PLAN.warmup_steps}::DOUBLE, 1.0::DOUBLE))) END"""
RATES = """rates AS (SELECT tl.k AS doc_id, count(coded.id) AS tokens, count(*) FILTER (coded.id > 1) AS known,
  count(*) FILTER (coded.id = 1) AS unknown FROM tl LEFT JOIN coded USING (k) GROUP BY tl.k)"""
UNKNOWN = f"""WITH {DOCS}, {VOCAB}, {TURNS}, {corpus("turns", "ex_id", simple_tokens("text"), "c")},
un AS (SELECT * FROM wcc WHERE token NOT IN (SELECT token FROM vocab))"""
SPLITN = f"floor(count(*)::DOUBLE * (1.0::DOUBLE - {PLAN.val_split}::DOUBLE))"

INSTRUCTIONS = f"""WITH {PAIRS},
ins AS (SELECT ex_id, prompt AS instruction, CASE conv_id % 3 WHEN 1 THEN '' WHEN 2 THEN ' context ' || conv_id || '  ' END AS input,
  CASE WHEN conv_id % 7 = 0 THEN '' ELSE response END AS output FROM pairs),
norm AS (SELECT ex_id, CASE WHEN coalesce(input, '') <> '' THEN regexp_replace(instruction || ' ' || input, {q("^[" + SPACE + "]+|[" + SPACE + "]+$")}, '', 'g')
  ELSE instruction END AS prompt, output AS response FROM ins WHERE output <> '' AND instruction <> '')"""

def POWER(n: int) -> str:
    """The leading axis v{n} of the symmetric matrix in a{n}, by squaring the matrix 40 times, and a{n+1},
    the matrix without that axis. The sign makes the largest loading positive."""
    square = "list_transform(m, lambda r: list_transform(m, lambda c: list_dot_product(r, c)))"
    return f"""p{n} AS (SELECT 0 AS k, a AS m FROM a{n} UNION ALL
        SELECT k + 1, list_transform(s, lambda r: list_transform(r, lambda z: z / top)) FROM (SELECT *, list_max(list_transform(s, lambda r: list_max(list_transform(r, lambda z: abs(z))))) AS top
          FROM (SELECT k, {square} AS s FROM p{n} WHERE k < 40))),
      u{n} AS (SELECT list_transform(w, lambda z: z / sqrt(list_dot_product(w, w))) AS v FROM (SELECT m[list_position(d, list_max(d))] AS w FROM
        (SELECT m, list_transform(range(1, len(m) + 1), lambda i: m[i][i]) AS d FROM p{n} WHERE k = 40))),
      v{n} AS (SELECT list_transform(v, lambda z: z * sign(v[list_position(b, list_max(b))])) AS v FROM (SELECT v, list_transform(v, lambda z: abs(z)) AS b FROM u{n})),
      a{n + 1} AS (SELECT list_transform(range(1, len(a) + 1), lambda i: list_transform(range(1, len(a) + 1), lambda j: a[i][j] - l * v[i] * v[j])) AS a
        FROM (SELECT a, v, list_dot_product(v, list_transform(a, lambda r: list_dot_product(r, v))) AS l FROM a{n}, v{n}))"""


def PCA(source: str) -> str:
    """pc: the coordinates of all vectors along the three leading axes of their covariance."""
    return f"""x AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM {source}),
      e AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM x), mu AS (SELECT i, avg(x) AS m FROM e GROUP BY i),
      c AS (SELECT vec_id, list(x - m ORDER BY i) AS v FROM e JOIN mu USING (i) GROUP BY vec_id),
      ce AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM c),
      cov AS (SELECT a.i, list(s ORDER BY j) AS r FROM (SELECT a.i, b.i AS j, sum(a.x * b.x) AS s FROM ce a JOIN ce b USING (vec_id) GROUP BY a.i, b.i) a GROUP BY a.i),
      a1 AS (SELECT list(r ORDER BY i) AS a FROM cov), {POWER(1)}, {POWER(2)}, {POWER(3)},
      pc AS (SELECT vec_id, list_dot_product(c.v, v1.v) AS pc1, list_dot_product(c.v, v2.v) AS pc2, list_dot_product(c.v, v3.v) AS pc3 FROM c, v1, v2, v3)"""


ORACLES = {
    "scan_text": "SELECT doc_id, text FROM documents",
    "scan_examples": f"WITH {TURNS} SELECT ex_id, 'text' AS kind, text FROM turns WHERE text <> ''",
    "detect_shape": f"""WITH {PAIRS}, j AS (SELECT ex_id, CASE (ex_id + conv_id) % 6
      WHEN 0 THEN json_object('messages', [prompt], 'text', response) WHEN 1 THEN json_object('instruction', prompt, 'output', response)
      WHEN 2 THEN json_object('prompt', prompt, 'chosen', response) WHEN 3 THEN json_object('question', prompt, 'gold', response)
      WHEN 4 THEN json_object('text', prompt) ELSE json_object('note', prompt) END AS js FROM pairs),
      k AS (SELECT ex_id, json_keys(js) AS k FROM j)
      SELECT ex_id, CASE WHEN list_contains(k, 'messages') THEN 'messages' WHEN list_contains(k, 'instruction') AND list_contains(k, 'output') THEN 'instruction'
      WHEN list_contains(k, 'chosen') OR list_contains(k, 'prompt') THEN 'preference'
      WHEN list_contains(k, 'question') AND list_has_any(k, ['prediction', 'answer', 'extracted_answer', 'gold']) THEN 'qa'
      WHEN list_contains(k, 'text') THEN 'text' ELSE 'fallback' END AS shape FROM k""",
    "normalize_mixed": f"""WITH {PAIRS}, m AS (SELECT *, (ex_id + conv_id) % 6 AS w FROM pairs)
      SELECT ex_id, ['messages', 'instruction', 'preference', 'qa', 'text', 'fallback'][w + 1] AS shape, CASE WHEN w IN (1, 2, 3) THEN 'pair' ELSE 'text' END AS kind,
        CASE WHEN w IN (1, 2, 3) THEN prompt END AS prompt, CASE WHEN w IN (1, 2, 3) THEN response END AS response, CASE WHEN w IN (0, 4, 5) THEN prompt END AS text
      FROM m WHERE CASE WHEN w IN (1, 2, 3) THEN prompt <> '' AND response <> '' WHEN w = 5 THEN true ELSE prompt <> '' END""",
    "normalize_messages": f"WITH {PAIRS} SELECT ex_id, prompt || ' ' || response || CASE WHEN conv_id % 2 = 0 THEN ' ' || prompt ELSE '' END AS text FROM pairs",
    "normalize_instruction": f"{INSTRUCTIONS} SELECT * FROM norm",
    "normalize_preference": f"""WITH {PAIRS} SELECT ex_id, 'string' AS form, prompt, response FROM pairs
      UNION ALL SELECT ex_id, 'list', prompt || ' ', response || ' ' || prompt FROM pairs""",
    "normalize_qa": f"WITH {PAIRS} SELECT ex_id, prompt, response FROM pairs",
    "normalize_text": "SELECT doc_id AS ex_id, text FROM documents WHERE text <> ''",
    "normalize_fallback": "SELECT page_id AS ex_id, url || ' ' || html AS text FROM pages",
    "flatten_for_vocab": f"""{INSTRUCTIONS} SELECT ex_id * 2 AS flat_id, ex_id, 0::BIGINT AS side, prompt AS text FROM norm
      UNION ALL SELECT ex_id * 2 + 1, ex_id, 1, response FROM norm""",
    "vocab_roundtrip": f"WITH {DOCS}, {VOCAB} SELECT id, token, n, {DEFAULT.min_frequency}::BIGINT AS min_frequency FROM vocab",
    "telemetry_append": f"""WITH {STEPS} SELECT run_id, step, epoch, round(loss, 4) AS loss, round(grad_norm, 4) AS grad_norm, round(accuracy, 4) AS accuracy,
      round({LR}, 8) AS lr FROM steps""",
    "telemetry_sink": f"""WITH {STEPS} SELECT run_id, step, epoch, round(loss, 4) AS loss, round(grad_norm, 4) AS grad_norm, round(accuracy, 4) AS accuracy,
      round({LR}, 8) AS lr FROM steps""",
    "metrics_files": f"""WITH {STEPS} SELECT run_id, step, epoch, round(loss, 4) AS loss, round(grad_norm, 4) AS grad_norm, round(accuracy, 4) AS accuracy,
      round({LR}, 8) AS lr FROM steps""",
    "telemetry_unpivot": f"WITH {STEPS} SELECT run_id, step, loss, grad_norm, accuracy FROM steps",
    "latest_state": f"""{TUNED}, adj AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS recency FROM r WHERE adjusted),
      z AS (SELECT run_id, max_by(clip, step) AS clip, max_by(scale, step) AS scale, max_by(smoothing, step) AS smoothing, max_by(dropout, step) AS dropout, max(step) AS at,
        max(adjustments) AS adjustments, string_agg(step::VARCHAR, ' ' ORDER BY step) FILTER (recency <= 10) AS recent FROM adj GROUP BY run_id),
      x AS (SELECT f.*, h.health, {RISK} AS risk FROM f JOIN h USING (run_id, step) QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY step DESC) = 1)
      SELECT u.run_id, coalesce(x.step, 0) AS step, coalesce(x.health, 'unknown') AS health, coalesce(r.reasons, '') AS reasons, coalesce(recent, '') AS recent,
        coalesce(x.nan_count, 0) AS nan_count, coalesce(z.adjustments, 0) AS adjustments, CASE WHEN x.step IS NULL THEN 0 ELSE greatest(0, 200 - (x.step - coalesce(z.at, -200))) END AS cooldown,
        {", ".join(f"round(coalesce({c}, 0), 10) AS {c}" for c in ("avg_loss", "avg_grad", "avg_accuracy", "max_grad", "min_grad", "risk"))},
        coalesce(z.clip, {PLAN.grad_clip}::DOUBLE) AS clip, coalesce(z.scale, 1.0::DOUBLE) AS scale, coalesce(z.smoothing, {PLAN.label_smoothing}::DOUBLE) AS smoothing,
        coalesce(z.dropout, {PLAN.dropout}::DOUBLE) AS dropout
      FROM (SELECT DISTINCT user_id % 11 AS run_id FROM events) u LEFT JOIN x USING (run_id) LEFT JOIN z USING (run_id) LEFT JOIN r ON r.run_id = x.run_id AND r.step = x.step AND r.i > 0""",
    "strip_accents": "SELECT doc_id, strip_accents(text) AS text FROM documents",
    "tokenize_default": f"SELECT doc_id, {show(simple_tokens('text'))} AS tokens FROM documents",
    "tokenize_conversational": f"SELECT doc_id, {show(CONV)} AS tokens FROM documents",
    "tokenize_technical": f"SELECT doc_id, {show(TECH)} AS tokens FROM documents",
    "word_counts": f"WITH {DOCS} SELECT token, n, (first // 4294967296)::BIGINT AS first_doc, (first % 4294967296)::BIGINT AS first_pos FROM wc",
    "vocab_min_freq": f"WITH {corpus('documents', 'doc_id', CONV)} SELECT token, n FROM wc WHERE n >= {CONVERSATIONAL.min_frequency}",
    "vocab_summary": f"""WITH {DOCS} SELECT count(*) AS seen, count(*) FILTER (n >= {DEFAULT.min_frequency}) AS kept,
      count(*) FILTER (n < {DEFAULT.min_frequency}) AS dropped, count(*) FILTER (n >= {DEFAULT.min_frequency}) + 4 AS vocab_size FROM wc""",
    "vocab_ids": f"WITH {DOCS}, {VOCAB} SELECT id, token, n FROM vocab",
    "vocab_capped": f"""WITH {DOCS}, cand AS (SELECT *, row_number() OVER (ORDER BY n DESC, first) AS f, row_number() OVER (ORDER BY first) AS o, count(*) OVER () AS c
      FROM wc WHERE n >= {DEFAULT.min_frequency})
      SELECT 3 + CASE WHEN c > {CAP - 4} THEN f ELSE o END AS id, token, n FROM cand WHERE c <= {CAP - 4} OR f <= {CAP - 4} UNION ALL {SPECIAL}""",
    "token_annotations": f"""{DOC_ENC} SELECT k AS doc_id, pos + 1 AS pos, token, id, CASE id WHEN 1 THEN 'unknown' ELSE 'known' END AS type FROM coded
      UNION ALL SELECT k, 0, '<SOS>', 2, 'special' FROM tl UNION ALL SELECT k, len(t) + 1, '<EOS>', 3, 'special' FROM tl""",
    "encode_docs": f"{DOC_ENC} SELECT k AS doc_id, {show('list_concat([2], ids, [3])')} AS ids FROM enc",
    "encode_fixed": f"{DOC_ENC} SELECT k AS doc_id, {show(fit('list_concat([2], ids, [3])', L))} AS ids FROM enc",
    "decode_docs": f"""{DOC_ENC} SELECT tl.k AS doc_id, coalesce(string_agg(token, ' ' ORDER BY pos) FILTER (id > 3), '') AS text FROM tl LEFT JOIN coded USING (k) GROUP BY tl.k""",
    "decode_keep_unk": f"""{DOC_ENC} SELECT tl.k AS doc_id, coalesce(string_agg(CASE id WHEN 1 THEN '<UNK>' ELSE token END, ' ' ORDER BY pos), '') AS text
      FROM tl LEFT JOIN coded USING (k) GROUP BY tl.k""",
    "doc_unk_rate": f"{DOC_ENC}, {RATES} SELECT *, round(unknown / greatest(tokens, 1)::DOUBLE, 6) AS unk_rate FROM rates",
    "unk_alerts": f"""{DOC_ENC}, {RATES} SELECT doc_id, tokens, unknown, round(unknown / tokens::DOUBLE, 6) AS unk_rate FROM rates
      WHERE tokens > 0 AND unknown / tokens::DOUBLE > {DEFAULT.unk_threshold}::DOUBLE""",
    "unk_global": f"""{DOC_ENC}, {RATES}, g AS (SELECT sum(tokens)::BIGINT AS tokens, sum(unknown)::BIGINT AS unknown, sum(unknown) / greatest(sum(tokens), 1)::DOUBLE AS r FROM rates)
      SELECT tokens, unknown, round(r, 6) AS unk_rate, CASE WHEN r > 0.10::DOUBLE THEN 'high' WHEN r > 0.05::DOUBLE THEN 'moderate' ELSE 'ok' END AS health FROM g""",
    "unk_words": f"{UNKNOWN} SELECT token, n FROM un",
    "top_unknown": f"{UNKNOWN} SELECT token, n FROM un ORDER BY n DESC, first LIMIT 10",
    "roundtrip_losses": f"""{DOC_ENC}, inv AS (SELECT DISTINCT k, token FROM coded WHERE id > 1), back AS (SELECT DISTINCT k, token FROM coded WHERE id > 1)
      SELECT k AS doc_id, token FROM inv ANTI JOIN back USING (k, token)""",
    "tokenizer_report": f"""{UNKNOWN}, r AS (SELECT sum(n)::BIGINT AS tokens, sum(n) FILTER (token NOT IN (SELECT token FROM vocab))::BIGINT AS unknown FROM wcc)
      SELECT '{DEFAULT.name}' AS encoding, {DEFAULT.min_frequency}::BIGINT AS min_frequency, true AS lowercase, 0::BIGINT AS vocab_cap, (SELECT count(*) FROM vocab) AS vocab_size,
      tokens, unknown, round(unknown / tokens::DOUBLE, 6) AS unk_rate,
      CASE WHEN unknown / tokens::DOUBLE > 0.10::DOUBLE THEN 'high' WHEN unknown / tokens::DOUBLE > 0.05::DOUBLE THEN 'moderate' ELSE 'ok' END AS health,
      (SELECT string_agg(token, ' ' ORDER BY n DESC, first) FROM (SELECT * FROM un ORDER BY n DESC, first LIMIT 10)) AS top_unknown FROM r""",
    "rebuilt_vocabulary": f"WITH {TURNS}, {CONVO}, {VOCAB} SELECT id, token, n FROM vocab",
    "pair_samples": f"{PAIR_IDS} SELECT ex_id, {show('src')} AS src, {show('tgt')} AS tgt FROM p",
    "encode_prompts": f"""{PAIR_IDS} SELECT pairs.ex_id, {show(fit("coalesce(sc.ids, []::BIGINT[])", L))} AS ids
      FROM pairs LEFT JOIN sc ON sc.ex_id = pairs.ex_id AND sc.side = 's'""",
    "sliding_windows": f"{DOC_ENC}, {WINDOWS} SELECT doc_id, start, {show('src')} AS src, {show('tgt')} AS tgt FROM win",
    "shifted_samples": f"""{DOC_ENC}, {WINDOWS} SELECT doc_id, start, {show('src')} AS encoder_input, {show(f'list_concat([2], tgt[1:{W - 1}])')} AS decoder_input,
      {show(f'list_concat(tgt[1:{W - 1}], [3])')} AS label FROM win""",
    "pad_masks": f"""{PAIR_IDS}, d AS (SELECT ex_id, src, list_concat([2], tgt) AS dec FROM p)
      SELECT ex_id, {show("list_transform(src, lambda i: (i <> 0)::INT)")} AS encoder_mask, {show("list_transform(dec, lambda i: (i <> 0)::INT)")} AS decoder_mask,
      len(list_filter(dec, lambda i: i <> 0)) AS visible_last FROM d""",
    "sample_counts": f"{DOC_ENC}, {WINDOWS} SELECT count(*) AS samples, count(DISTINCT doc_id) AS texts FROM win",
    "step_budget": f"""{DOC_ENC}, {WINDOWS} SELECT count(*) AS samples, count(*) // {PLAN.batch_size} AS batches,
      (count(*) // {PLAN.batch_size}) * {PLAN.epochs} AS total_steps FROM win""",
    "train_val_split": f"""SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) <= (SELECT {SPLITN} FROM documents) THEN 'train' ELSE 'val' END AS split FROM documents""",
    "batches": f"""{DOC_ENC}, {WINDOWS}, o AS (SELECT doc_id, start, row_number() OVER (ORDER BY doc_id, start) - 1 AS i, count(*) OVER () AS n FROM win)
      SELECT doc_id, start, i // {PLAN.batch_size} AS batch, i % {PLAN.batch_size} AS slot FROM o WHERE i < n // {PLAN.batch_size} * {PLAN.batch_size}""",
    "shuffled_batches": f"""{DOC_ENC}, {WINDOWS}, o AS (SELECT doc_id, start, row_number() OVER (ORDER BY ('0x' || substr(md5('7:' || doc_id || ':' || start), 1, 15))::BIGINT, doc_id, start) - 1 AS i,
      count(*) OVER () AS n FROM win)
      SELECT doc_id, start, i // {PLAN.batch_size} AS batch, i % {PLAN.batch_size} AS slot FROM o WHERE i < n // {PLAN.batch_size} * {PLAN.batch_size}""",
    "prediction_samples": f"""{DOC_ENC}, {WINDOWS}, o AS (SELECT *, row_number() OVER (ORDER BY doc_id, start) - 1 AS i, count(*) OVER () AS n FROM win),
      b AS (SELECT doc_id, start, i // 16 AS batch, i % 16 AS slot, src, list_concat(tgt[1:{W - 1}], [3]) AS lab FROM o WHERE i < n // 16 * 16 AND i % 16 < 10),
      e AS (SELECT doc_id, start, 's' AS what, unnest(src) AS id, generate_subscripts(src, 1) AS pos FROM b
        UNION ALL SELECT doc_id, start, 't', unnest(lab), generate_subscripts(lab, 1) FROM b),
      d AS (SELECT doc_id, start, what, string_agg(token, ' ' ORDER BY pos) AS fwd, string_agg(token, ' ' ORDER BY pos DESC) AS bwd
        FROM e JOIN words USING (id) GROUP BY ALL)
      SELECT b.doc_id, b.start, batch, slot, coalesce(x.fwd, '') AS source, coalesce(y.fwd, '') AS target, coalesce(y.bwd, '') AS predicted FROM b
      LEFT JOIN d x ON x.doc_id = b.doc_id AND x.start = b.start AND x.what = 's' LEFT JOIN d y ON y.doc_id = b.doc_id AND y.start = b.start AND y.what = 't'""",
    "argmax_predictions": f"WITH {VEC} SELECT vec_id, list_position(v, list_max(v))::BIGINT - 1 AS predicted FROM x",
    "smoothed_cross_entropy": f"""WITH {VEC} SELECT vec_id, round((lse - v[label + 1]) * {1 - PLAN.label_smoothing}::DOUBLE
      + (lse - list_sum(v) / len(v)) * {PLAN.label_smoothing}::DOUBLE, 6) AS loss FROM s WHERE label <> 0""",
    "row_entropy": f"WITH {VEC} SELECT vec_id, round(-list_sum(list_transform(v, lambda e: exp(e - lse) * ln(exp(e - lse) + 1e-9))), 6) AS entropy FROM s",
    "token_accuracy": f"""WITH {VEC}, h AS (SELECT vec_id // 10 AS batch, label <> 0 AS c, label <> 0 AND list_position(v, list_max(v)) - 1 = label AS ok FROM x)
      SELECT batch, count(*) FILTER (ok) AS correct, count(*) FILTER (c) AS counted, round(count(*) FILTER (ok) / greatest(count(*) FILTER (c), 1)::DOUBLE, 6) AS accuracy FROM h GROUP BY batch""",
    "token_accuracy_overall": f"""WITH {VEC}, h AS (SELECT vec_id // 10 AS batch, label <> 0 AS c, label <> 0 AND list_position(v, list_max(v)) - 1 = label AS ok FROM x),
      b AS (SELECT batch, count(*) FILTER (ok) AS correct, count(*) FILTER (c) AS counted FROM h GROUP BY batch)
      SELECT round(avg(correct / greatest(counted, 1)::DOUBLE), 6) AS macro_accuracy, round(sum(correct) / greatest(sum(counted), 1)::DOUBLE, 6) AS micro_accuracy, sum(counted)::BIGINT AS counted FROM b""",
    "epoch_summary": f"WITH {STEPS} SELECT run_id, epoch, count(*) AS batches, round(avg(loss), 10) AS mean_loss FROM steps GROUP BY run_id, epoch",
    "perplexity": f"WITH {STEPS} SELECT run_id, epoch, round(exp(least(avg(loss) / 8, 20)), 4) AS perplexity FROM steps GROUP BY run_id, epoch",
    "throughput": f"""WITH {STEPS}, t AS (SELECT run_id, step, count(*) OVER w AS b, (micros - min(micros) OVER w) / 1e6::DOUBLE AS el FROM steps
      WINDOW w AS (PARTITION BY run_id, epoch ORDER BY step))
      SELECT run_id, step, round(b * {PLAN.batch_size * PLAN.seq_length} / greatest(el, 1.0::DOUBLE), 6) AS tokens_per_second, round(el / b, 6) AS batch_time FROM t""",
    "best_epochs": f"""WITH {STEPS}, {VAL} SELECT run_id, epoch, round(val_loss, 10) AS val_loss,
      val_loss < coalesce(min(val_loss) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'Infinity'::DOUBLE) AS is_best FROM val""",
    "entropy_by_group": f"""WITH {ATTN} SELECT item, layer, head, round(avg(-list_sum(list_transform(w[1:32], lambda p: p * ln(p + 1e-9)))), 6) AS entropy
      FROM att WHERE row < 32 GROUP BY item, layer, head""",
    "entropy_global": f"""WITH {ATTN}, c AS (SELECT item, row, unnest(w) AS p, generate_subscripts(w, 1) AS col FROM att WHERE layer = 0),
      m AS (SELECT item, row, col, avg(p) AS p FROM c GROUP BY ALL), r AS (SELECT item, row, -sum(p * ln(p + 1e-9)) AS e FROM m GROUP BY ALL)
      SELECT item, round(avg(e), 6) AS entropy FROM r GROUP BY item""",
    "knn_cosine": f"WITH {KNN} SELECT id, neighbour, round(sim, 6) AS sim, rank FROM knn",
    "knn_edges": f"""WITH {KNN}, e AS (SELECT least(id, neighbour) AS lo, greatest(id, neighbour) AS hi, min(id) AS src FROM knn GROUP BY ALL)
      SELECT src, CASE WHEN src = lo THEN hi ELSE lo END AS dst FROM e""",
    "pca_3d": f"""WITH RECURSIVE {PCA("embeddings")} SELECT vec_id, round(pc1, 6) AS pc1, round(pc2, 6) AS pc2, round(pc3, 6) AS pc3 FROM pc""",
    "word_map_nodes": f"""WITH RECURSIVE {DOCS}, {VOCAB}, {PCA("(SELECT * FROM embeddings WHERE vec_id >= 4)")},
      b AS (SELECT min(pc1) AS x0, max(pc1) AS x1, min(pc2) AS y0, max(pc2) AS y1, min(pc3) AS z0, max(pc3) AS z1 FROM pc)
      SELECT vec_id AS id, coalesce(vocab.token, '?') AS word, round((pc1 - x0) / greatest(x1 - x0, 1e-6) * 2 - 1, 4) AS x, round((pc2 - y0) / greatest(y1 - y0, 1e-6) * 2 - 1, 4) AS y,
        round((pc3 - z0) / greatest(z1 - z0, 1e-6) * 2 - 1, 4) AS z FROM pc CROSS JOIN b LEFT JOIN vocab ON vocab.id = pc.vec_id""",
    "word_map_edges": f"""WITH {KNN.replace("FROM embeddings", "FROM embeddings WHERE vec_id >= 4")}, e AS (SELECT least(id, neighbour) AS lo, greatest(id, neighbour) AS hi, min(id) AS src FROM knn GROUP BY ALL)
      SELECT src, CASE WHEN src = lo THEN hi ELSE lo END AS dst FROM e""",
    "roundtrip_report": f"""{DOC_ENC} SELECT tl.k AS doc_id, count(DISTINCT token) FILTER (id > 3) AS checked,
      count(DISTINCT token) FILTER (id > 3) - count(DISTINCT token) FILTER (id > 3 AND pos < {L - 1}) AS lost FROM tl LEFT JOIN coded USING (k) GROUP BY tl.k""",
    "scan_first_share": "SELECT doc_id, text FROM documents QUALIFY row_number() OVER (ORDER BY doc_id) <= floor(count(*) OVER () * 2 / 5)",
    "vector_moments": """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1)::BIGINT AS i FROM embeddings)
      SELECT a.i, b.i AS j, round(avg(a.x), 8) AS mean_i, round(covar_samp(a.x, b.x), 8) AS covariance
      FROM e a JOIN e b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.i, b.i""",
    "word_map_scale": "SELECT count(*) AS n, -1.0::DOUBLE AS low, 1.0::DOUBLE AS high FROM embeddings",
    "minmax_scale": """WITH a AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings),
      b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1 FROM a)
      SELECT vec_id, round((x - x0) / greatest(x1 - x0, 1e-6) * 2 - 1, 4) AS x, round((y - y0) / greatest(y1 - y0, 1e-6) * 2 - 1, 4) AS y,
      round((z - z0) / greatest(z1 - z0, 1e-6) * 2 - 1, 4) AS z FROM a, b""",
    "lr_schedule": f"WITH {STEPS} SELECT run_id, step, round({LR}, 8) AS lr FROM steps",
    "ema_loss": f"""WITH {STEPS}, li AS (SELECT run_id, list(loss ORDER BY step) AS a FROM steps GROUP BY run_id),
      e AS (SELECT steps.run_id, steps.step, list_reduce(a[1:steps.step], lambda p, x: 0.95::DOUBLE * p + 0.05::DOUBLE * x) AS ema FROM steps JOIN li USING (run_id))
      SELECT run_id, step, round(ema, 6) AS ema FROM e""",
    "ema_rounded": f"""WITH RECURSIVE {STEPS}, e AS (SELECT run_id, step, format('{{:.4f}}', loss)::DOUBLE AS ema FROM steps WHERE step = 1
      UNION ALL SELECT s.run_id, s.step, format('{{:.4f}}', 0.95::DOUBLE * e.ema + (1.0::DOUBLE - 0.95::DOUBLE) * s.loss)::DOUBLE FROM e JOIN steps s ON s.run_id = e.run_id AND s.step = e.step + 1)
      SELECT run_id, step, ema FROM e""",
    "sampled_steps": f"""WITH {STEPS}, b AS (SELECT run_id, step, step - min(step) OVER w + 1 AS batch, max(step) OVER w AS last, loss FROM steps WINDOW w AS (PARTITION BY run_id, epoch))
      SELECT run_id, step, batch, loss FROM b WHERE batch % {PLAN.log_interval} = 0 OR step = last""",
    "accumulation_steps": f"""WITH {STEPS}, b AS (SELECT *, step - min(step) OVER w + 1 AS batch, max(step) OVER w AS last FROM steps WINDOW w AS (PARTITION BY run_id, epoch)),
      c AS (SELECT *, batch % {PLAN.accum_steps} = 0 OR step = last AS is_step FROM b)
      SELECT run_id, step, is_step, CASE WHEN is_step THEN round(grad_norm, 6) ELSE 0.0 END AS grad_norm FROM c""",
    "gradient_flags": f"WITH {NOISY}, {GRAD_WIN} SELECT run_id, step, {GRAD_FLAGS} FROM gf",
    "plateau_flags": f"WITH {NOISY}, {LOSS_WIN} SELECT run_id, step, {PLATEAU} FROM lf",
    "accuracy_trend": f"WITH {NOISY}, {STEP_WIN} SELECT run_id, step, {ACC_FLAGS} FROM sf",
    "overconfidence_flags": f"WITH {NOISY}, {STEP_WIN} SELECT run_id, step, {CONF_FLAGS} FROM sf",
    "spike_flags": f"WITH {NOISY}, {LOSS_WIN} SELECT run_id, step, {DIV_FLAGS} FROM ns JOIN lf USING (run_id, step)",
    "overconfidence_risk": f"""WITH {NOISY}, {LOSS_WIN}, {STEP_WIN} SELECT run_id, step, CASE WHEN n_acc < 30 THEN 0.0 ELSE
      round(least(greatest(0, acc_recent - 0.5::DOUBLE) / 0.5::DOUBLE * CASE WHEN n_loss >= 30 AND loss_early > 0 THEN greatest(0, 1 - (loss_early - loss_late) / loss_early) ELSE 0 END, 1), 6) END AS risk
      FROM sf JOIN lf USING (run_id, step)""",
    "rolling_diagnostics": f"""WITH {NOISY}, {LOSS_WIN}, {GRAD_WIN}, {STEP_WIN} SELECT run_id, step, round(coalesce(avg_loss, 0), 10) AS avg_loss, round(coalesce(avg_grad, 0), 10) AS avg_grad,
      round(avg_accuracy, 10) AS avg_accuracy, round(coalesce(max_grad, 0), 10) AS max_grad, round(coalesce(min_grad, 0), 10) AS min_grad
      FROM sf JOIN lf USING (run_id, step) JOIN gf USING (run_id, step)""",
    "asof_val_loss": f"WITH {NOISY}, {VAL} SELECT run_id, step, round({KNOWN_VAL}, 10) AS val_loss FROM ns",
    "overfit_flags": f"""WITH {NOISY}, {VAL}, f AS (SELECT *, {KNOWN_VAL} AS val_loss FROM ns)
      SELECT run_id, step, coalesce(step >= 30 AND val_loss > loss * 1.15::DOUBLE AND accuracy > 0.4::DOUBLE, false) AS sft_overfitting FROM f""",
    "recommendations": f"""WITH {STEPS}, {VAL}, k AS (SELECT steps.run_id, steps.step, steps.loss, steps.epoch + 1 AS ep, v.attn_entropy AS ent, v.memory_gb AS mem
      FROM steps ASOF LEFT JOIN val v ON steps.run_id = v.run_id AND steps.step > v.step WHERE steps.step >= 30)
      SELECT run_id, step, 'dModel / Heads' AS param, 'Increase' AS action, 'High training loss after multiple epochs. Model capacity may be too low.' AS reason FROM k WHERE loss > 4.5 AND ep > 2
      UNION ALL SELECT run_id, step, 'Heads (h)', 'Increase', format('Low attention entropy ({{:.2f}}). Attention is too focused.', ent) FROM k WHERE ent > 0 AND ent < 1.5
      UNION ALL SELECT run_id, step, 'Layers (N)', 'Decrease', format('High attention entropy ({{:.2f}}). Attention is too diffuse.', ent) FROM k WHERE ent > 5.0
      UNION ALL SELECT run_id, step, 'Batch Size / Seq Len', 'Decrease', format('Memory usage is very high ({{:.1f}} GB).', mem) FROM k WHERE mem > 14.0""",
    "health_status": f"{health(NOISY + ', ' + VAL, KNOWN_VAL)} SELECT run_id, step, health, nan_count FROM h",
    "tuner_replay": f"""{TUNED} SELECT run_id, step, reasons, adjusted, clip, scale, smoothing, dropout, adjustments FROM r WHERE i > 0""",
    "adjustment_summary": f"{TUNED} SELECT run_id, reason, count(*) AS n FROM (SELECT run_id, unnest(string_split(reasons, ' ')) AS reason FROM r WHERE adjusted) GROUP BY ALL",
    "tuner_summary": f"""{TUNED}, z AS (SELECT run_id, clip, scale, smoothing, dropout, adjustments FROM r QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY i DESC) = 1)
      SELECT run_id, h.step AS steps, coalesce(adjustments, 0) AS adjustments, nan_count AS nan_events, coalesce(clip, {PLAN.grad_clip}::DOUBLE) AS clip, coalesce(scale, 1.0::DOUBLE) AS scale,
        coalesce(smoothing, {PLAN.label_smoothing}::DOUBLE) AS smoothing, coalesce(dropout, {PLAN.dropout}::DOUBLE) AS dropout, health
      FROM (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY step DESC) = 1) h LEFT JOIN z USING (run_id)""",
    "recent_adjustments": f"""{TUNED} SELECT run_id, step, row_number() OVER (PARTITION BY run_id ORDER BY step DESC)::INT AS recency, clip, scale, smoothing, dropout
      FROM r WHERE adjusted QUALIFY recency <= 10""",
    "lr_effective": f"""{TUNED}, known AS (SELECT steps.run_id, steps.step, coalesce(r.scale, 1.0::DOUBLE) AS lr_scale FROM steps
      ASOF LEFT JOIN (SELECT * FROM r WHERE adjusted) r ON steps.run_id = r.run_id AND steps.step > r.step)
      SELECT run_id, step, lr_scale, round({LR} * lr_scale, 12) AS effective_lr FROM known""",
    "stream_scan": "SELECT doc_id, text FROM documents",
    "stream_encode": f"{DOC_ENC} SELECT k AS doc_id, {show(fit('list_concat([2], ids, [3])', L))} AS ids FROM enc",
    "stream_unk": f"{DOC_ENC}, {RATES} SELECT sum(tokens)::BIGINT AS tokens, sum(unknown)::BIGINT AS unknown FROM rates",
    "stream_ema": f"""WITH {STEPS}, li AS (SELECT run_id, list(loss ORDER BY step) AS a FROM steps GROUP BY run_id)
      SELECT run_id, event_id, step, round(list_reduce(a[1:step], lambda p, x: 0.95::DOUBLE * p + 0.05::DOUBLE * x), 6) AS ema FROM steps JOIN li USING (run_id)""",
    "stream_health": f"""{tuned(STEPS + ', ns AS (SELECT run_id, step, epoch, accuracy, event_id, ' + noise("event_id") + ' FROM steps), ' + VAL, KNOWN_VAL)}
      SELECT h.run_id, h.event_id, h.step, h.health, coalesce(x.reasons, '') AS reasons, coalesce(x.adjusted, false) AS adjusted, h.nan_count, coalesce(s.clip, {PLAN.grad_clip}::DOUBLE) AS clip,
        coalesce(s.scale, 1.0::DOUBLE) AS scale, coalesce(s.smoothing, {PLAN.label_smoothing}::DOUBLE) AS smoothing, coalesce(s.dropout, {PLAN.dropout}::DOUBLE) AS dropout, coalesce(s.adjustments, 0) AS adjustments
      FROM h LEFT JOIN r x ON x.run_id = h.run_id AND x.step = h.step AND x.i > 0 ASOF LEFT JOIN r s ON s.run_id = h.run_id AND h.step >= s.step""",
}
