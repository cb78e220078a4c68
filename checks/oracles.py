"""SQL for another engine, stating what each query must return on the same tables."""

from __future__ import annotations

MEDS = [
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride", "acetohexamide",
    "glipizide", "glyburide", "tolbutamide", "pioglitazone", "rosiglitazone", "acarbose",
    "miglitol", "troglitazone", "tolazamide", "examide", "citoglipton", "insulin",
    "glyburide-metformin", "glipizide-metformin", "glimepiride-pioglitazone",
    "metformin-rosiglitazone", "metformin-pioglitazone",
]
NUM = [
    "age_ordinal", "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_diagnoses", "num_med_changes", "num_meds_active", "total_prior_visits",
    "insulin_changed", "high_utilizer", "medical_specialty_missing", "num_emergency_visits",
    "num_inpatient_visits", "num_outpatient_visits", "lab_procedure_intensity",
    "procedure_intensity", "medication_intensity", "diagnosis_complexity", "med_change_ratio",
    "A1Cresult_abnormal", "diabetesMed_flag", "change_flag",
]
RATIOS = ["lab_procedure_intensity", "procedure_intensity", "medication_intensity",
          "diagnosis_complexity", "med_change_ratio"]
CAT = ["race", "gender", "diag1_category", "diag2_category", "diag3_category", "admission_type_id",
       "discharge_disposition_grouped", "admission_source_grouped"]
SUMMARY = ["time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications", "number_outpatient",
           "number_emergency", "number_inpatient", "number_diagnoses"]
LINEAR = [(f, repr(((7 * i) % 11 - 5) / 50), repr(float((3 * i) % 7))) for i, f in enumerate(NUM)]


def r6(expr: str) -> str:
    """Six decimals without a negative zero."""
    return f"(round(({expr})::double, 6) + 0.0)"


# ---- derived tables ------------------------------------------------------------

def _diag(a: int, i: int) -> str:
    e = f"((o_orderkey * {a} + o_custkey * {i}) % 1100)"
    return (
        f"CASE WHEN {e} >= 1080 THEN NULL WHEN {e} >= 1060 THEN '?' "
        f"WHEN {e} >= 1030 THEN 'V' || ({e} % 90) WHEN {e} >= 1000 THEN 'E' || ({e} % 1000) "
        f"WHEN {e} % 4 = 0 THEN {e} || '.5' ELSE {e}::varchar END AS diag_{i}"
    )


def _med(j: int, name: str) -> str:
    h = f"((o_orderkey * {2 * j + 3} + o_custkey * {j + 1} + {j}) % 16)"
    idle = 7 if name == "insulin" else 12
    return (
        f"CASE WHEN {h} < {idle} THEN 'No' WHEN {h} = 15 THEN 'Up' WHEN {h} = 14 THEN 'Down' "
        f"ELSE 'Steady' END AS \"{name}\""
    )


RAW = f"""
lines AS (
  SELECT l_orderkey, sum(l_quantity)::bigint AS qty, 7 * count(*) AS items
  FROM lineitem GROUP BY l_orderkey),
base AS (
  SELECT o.*, c.c_nationkey, l.qty, l.items,
    CASE WHEN o_custkey % 5 < 3 THEN 0 ELSE o_orderkey % 4 END::bigint AS inp,
    CASE WHEN o_orderkey % 7 < 5 THEN 0 ELSE o_custkey % 5 END::bigint AS emer,
    CASE WHEN (o_orderkey + o_custkey) % 9 < 6 THEN 0 ELSE o_custkey % 8 END::bigint AS outp
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN lines l ON l.l_orderkey = o.o_orderkey),
raw AS (
  SELECT o_orderkey AS encounter_id, 8 * o_custkey + o_orderkey % 8 AS patient_nbr,
    CASE c_nationkey % 6 WHEN 0 THEN 'Caucasian' WHEN 1 THEN 'AfricanAmerican'
      WHEN 2 THEN 'Hispanic' WHEN 3 THEN 'Asian' WHEN 4 THEN 'Other' END AS race,
    CASE WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CASE WHEN o_orderkey % 89 = 0 THEN 'unknown'
      ELSE '[' || (10 * ((7 * o_custkey + o_orderkey) % 10)) || '-'
        || (10 * ((7 * o_custkey + o_orderkey) % 10) + 10) || ')' END AS age,
    NULL::varchar AS weight, 1 + o_orderkey % 8 AS admission_type_id,
    1 + o_custkey % 28 AS discharge_disposition_id,
    1 + (3 * o_orderkey + o_custkey) % 25 AS admission_source_id,
    CASE WHEN o_orderkey % 97 = 0 THEN 0 ELSE 1 + (5 * o_orderkey + o_custkey) % 14 END::bigint
      AS time_in_hospital,
    NULL::varchar AS payer_code,
    CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderpriority END AS medical_specialty,
    qty % 133 AS num_lab_procedures, o_orderkey % 7 AS num_procedures,
    items % 82 AS num_medications, outp AS number_outpatient, emer AS number_emergency,
    inp AS number_inpatient, {_diag(37, 1)}, {_diag(53, 2)}, {_diag(71, 3)},
    1 + (o_orderkey + o_custkey) % 16 AS number_diagnoses, 'None' AS max_glu_serum,
    CASE (o_orderkey + o_custkey) % 10 WHEN 0 THEN '>7' WHEN 1 THEN '>8' WHEN 2 THEN 'Norm'
      ELSE 'None' END AS "A1Cresult",
    {", ".join(_med(j, m) for j, m in enumerate(MEDS))},
    CASE WHEN o_orderkey % 3 = 0 THEN 'No' ELSE 'Ch' END AS "change",
    CASE WHEN o_orderkey % 4 = 0 THEN 'No' ELSE 'Yes' END AS "diabetesMed",
    CASE WHEN 3 * inp + 2 * emer + (7919 * o_orderkey) % 23 >= 22 THEN '<30'
      WHEN 3 * inp + 2 * emer + (7919 * o_orderkey) % 23 >= 17 THEN '>30' ELSE 'NO' END AS readmitted
  FROM base)"""

# What a scan delivers: question marks and the text None are missing.
ENC = RAW + """,
enc AS (
  SELECT * REPLACE (
    nullif(diag_1, '?') AS diag_1, nullif(diag_2, '?') AS diag_2, nullif(diag_3, '?') AS diag_3,
    nullif("A1Cresult", 'None') AS "A1Cresult", nullif(max_glu_serum, 'None') AS max_glu_serum)
  FROM raw)"""

FIRST = """
first_enc AS (
  SELECT * FROM enc
  QUALIFY row_number() OVER (PARTITION BY patient_nbr ORDER BY encounter_id) = 1)"""

ICD_NUMBER = (
    "CASE WHEN regexp_full_match(trim({c}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
    "THEN try_cast(trim({c}) AS double) END"
)


def icd(code: str, number: str) -> str:
    return f"""CASE WHEN {code} IS NULL OR trim({code}) = '' THEN 'Other'
      WHEN upper(substr(trim({code}), 1, 1)) IN ('V', 'E') THEN 'External'
      WHEN {number} IS NULL THEN 'Other'
      WHEN {number} = 785 THEN 'Circulatory' WHEN {number} = 786 THEN 'Respiratory'
      WHEN {number} = 787 THEN 'Digestive' WHEN {number} = 788 THEN 'Genitourinary'
      WHEN trunc({number}) BETWEEN 249 AND 259 THEN 'Diabetes'
      WHEN trunc({number}) BETWEEN 390 AND 459 THEN 'Circulatory'
      WHEN trunc({number}) BETWEEN 460 AND 519 THEN 'Respiratory'
      WHEN trunc({number}) BETWEEN 520 AND 579 THEN 'Digestive'
      WHEN trunc({number}) BETWEEN 580 AND 629 THEN 'Genitourinary'
      WHEN trunc({number}) BETWEEN 710 AND 739 THEN 'Musculoskeletal'
      WHEN trunc({number}) BETWEEN 800 AND 999 THEN 'Injury'
      WHEN trunc({number}) BETWEEN 140 AND 239 THEN 'Neoplasms' ELSE 'Other' END"""


DIAG_COLUMNS = ", ".join(icd(f"diag_{i}", f"n{i}") + f" AS diag{i}_category" for i in (1, 2, 3))
DIAG_NUMBERS = ", ".join(ICD_NUMBER.format(c=f"diag_{i}") + f" AS n{i}" for i in (1, 2, 3))
CHANGES = " + ".join(f"coalesce((\"{m}\" IN ('Up', 'Down'))::int, 0)" for m in MEDS)
ACTIVE = " + ".join(f"coalesce((\"{m}\" IN ('Up', 'Down', 'Steady'))::int, 0)" for m in MEDS)
AGE = "coalesce(CASE WHEN age LIKE '[%' THEN substr(age, 2, strpos(age, '-') - 2)::int // 10 END, -1)::int"
STAY = "(CASE WHEN time_in_hospital < 1 THEN 1 ELSE time_in_hospital END)"
DISCHARGE = """CASE WHEN discharge_disposition_id = 1 THEN 'Home'
  WHEN discharge_disposition_id IN (2, 3, 4, 5) THEN 'Transfer'
  WHEN discharge_disposition_id IN (6, 8) THEN 'Home_Health'
  WHEN discharge_disposition_id IN (7, 9, 10, 12) THEN 'AMA_Left'
  WHEN discharge_disposition_id IN (11, 13, 14, 15, 22, 23, 24) THEN 'SNF_Rehab' ELSE 'Other' END"""
SOURCE = """CASE WHEN admission_source_id IN (1, 2, 3) THEN 'Referral'
  WHEN admission_source_id IN (4, 5, 6, 10, 22) THEN 'Transfer'
  WHEN admission_source_id = 7 THEN 'Emergency' WHEN admission_source_id = 8 THEN 'Court_Law'
  ELSE 'Other' END"""


def feat(source: str, name: str = "feat") -> str:
    """CTE of all model columns over a table of encounters."""
    return f"""
{name} AS (
  SELECT encounter_id, (readmitted = '<30')::int AS readmitted, race, gender,
    admission_type_id::varchar AS admission_type_id, time_in_hospital, num_lab_procedures,
    num_procedures, num_medications, number_diagnoses, {DIAG_COLUMNS},
    ({CHANGES})::int AS num_med_changes, ({ACTIVE})::int AS num_meds_active,
    (insulin IN ('Up', 'Down'))::int AS insulin_changed,
    number_emergency AS num_emergency_visits, number_inpatient AS num_inpatient_visits,
    number_outpatient AS num_outpatient_visits,
    number_inpatient + number_outpatient + number_emergency AS total_prior_visits,
    coalesce((number_inpatient + number_outpatient + number_emergency >= 5)::int, 0)::int AS high_utilizer,
    {AGE} AS age_ordinal, num_lab_procedures / {STAY} AS lab_procedure_intensity,
    num_procedures / {STAY} AS procedure_intensity, num_medications / {STAY} AS medication_intensity,
    number_diagnoses / {STAY} AS diagnosis_complexity,
    ({CHANGES})::double / (({ACTIVE}) + 1) AS med_change_ratio,
    coalesce(("A1Cresult" IN ('>7', '>8'))::int, 0)::int AS "A1Cresult_abnormal",
    ("diabetesMed" = 'Yes')::int AS "diabetesMed_flag", ("change" = 'Ch')::int AS change_flag,
    {DISCHARGE} AS discharge_disposition_grouped, {SOURCE} AS admission_source_grouped,
    (medical_specialty IS NULL)::int AS medical_specialty_missing
  FROM (SELECT *, {DIAG_NUMBERS} FROM {source}))"""


ROWS = f"WITH {ENC}, {FIRST}, {feat('first_enc')}"
W_ENC = f"WITH {ENC}"
SCORED = """
scored AS (
  SELECT encounter_id, (readmitted = '<30')::int AS y,
    round(1 / (1 + exp(-(-3.0::double + 0.45::double * number_inpatient
      + 0.3::double * number_emergency + 0.04::double * time_in_hospital
      + 0.01::double * (encounter_id % 11)))), 6) AS p,
    gender, race, """ + AGE + """ AS age_ordinal, admission_type_id
  FROM enc)"""
W_SCORED = f"WITH {ENC}, {SCORED}"
TWO = """
two AS (
  SELECT encounter_id, (readmitted = '<30')::int AS y, 'first' AS model,
    round(1 / (1 + exp(-(-3.0::double + 0.45::double * number_inpatient + 0.3::double * number_emergency))), 6) AS p
  FROM enc
  UNION ALL
  SELECT encounter_id, (readmitted = '<30')::int, 'second',
    round(1 / (1 + exp(-(-1.0::double + 0.5::double * number_inpatient + 0.02::double * time_in_hospital))), 6)
  FROM enc)"""
CUT = "0.12"


def curve(source: str, keys: str = "") -> str:
    """CTEs ``cnt``, ``cum``: counts per score, and running counts from the top."""
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys} " if keys else ""
    return f"""
cnt AS (SELECT {k}p, sum(y)::bigint AS pos, sum(1 - y)::bigint AS neg FROM {source} GROUP BY {k}p),
cum AS (
  SELECT *, (sum(pos) OVER ({part}ORDER BY p DESC))::bigint AS tp,
    (sum(neg) OVER ({part}ORDER BY p DESC))::bigint AS fp,
    sum(pos) OVER ({part}) AS ap, sum(neg) OVER ({part}) AS an
  FROM cnt)"""


AUC = "sum(pos * ((an - fp) + neg / 2)) / (max(ap) * max(an))"
AP = "sum((pos / ap) * (tp / (tp + fp)))"
BRIER = "sum(pos * (p - 1) * (p - 1) + neg * p * p) / sum(pos + neg)"


def at_cut(cut: str) -> tuple[str, str, str]:
    tp = f"sum(CASE WHEN p >= {cut} THEN pos ELSE 0 END)"
    hits = f"sum(CASE WHEN p >= {cut} THEN pos + neg ELSE 0 END)"
    precision = f"coalesce({tp} / nullif({hits}, 0), 0)"
    recall = f"coalesce({tp} / nullif(sum(pos), 0), 0)"
    f1 = f"coalesce(2 * {tp} / nullif({hits} + sum(pos), 0), 0)"
    return precision, recall, f1


PRECISION, RECALL, F1 = at_cut(CUT)


def long(source: str, columns: list[str], keep: str = "", kind: str = "double") -> str:
    """Union of one select per column: ``(keep, feature, value)``."""
    k = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"SELECT {k}'{c}' AS feature, \"{c}\"::{kind} AS value FROM {source}" for c in columns
    )


SIDES = f"""
{feat('enc')},
side AS (
  SELECT * REPLACE (CASE WHEN encounter_id % 3 = 0 THEN time_in_hospital + 2
      ELSE time_in_hospital END AS time_in_hospital),
    encounter_id % 3 = 0 AS cur FROM feat),
lv AS (SELECT * FROM ({long('side', NUM, 'cur')}) WHERE value IS NOT NULL)"""
W_SIDES = f"WITH {ENC}, {SIDES}"


def psi_ks(values: str) -> str:
    """CTEs ``psi`` and ``ks`` over ``(feature, value, cur)``."""
    return f"""
ext AS (SELECT feature, min(value) AS lo, max(value) AS hi, count(*) FILTER (NOT cur) AS tr,
    count(*) FILTER (cur) AS tc FROM {values} GROUP BY feature
    HAVING count(*) FILTER (NOT cur) > 0 AND count(*) FILTER (cur) > 0),
edges AS (SELECT feature, i, CASE WHEN i = 10 THEN hi ELSE lo + i * ((hi - lo) / 10.0::double) END AS edge
    FROM ext, range(11) AS g(i)),
vals AS (SELECT feature, value, count(*) FILTER (NOT cur) AS nr, count(*) FILTER (cur) AS nc
    FROM {values} GROUP BY feature, value),
binned AS (SELECT v.feature, v.value, any_value(v.nr) AS nr, any_value(v.nc) AS nc,
    least(count(*) FILTER (e.edge <= v.value) - 1, 9) AS bin
    FROM vals v JOIN edges e ON v.feature = e.feature GROUP BY v.feature, v.value),
bins AS (SELECT feature, bin, sum(nr) AS nr, sum(nc) AS nc FROM binned GROUP BY feature, bin),
shares AS (SELECT b.feature, lo, hi,
    CASE WHEN nr = 0 THEN 0.0001::double ELSE nr / tr END AS s_r,
    CASE WHEN nc = 0 THEN 0.0001::double ELSE nc / tc END AS s_c
    FROM bins b JOIN ext ON b.feature = ext.feature),
psi AS (SELECT feature, sum(CASE WHEN lo = hi THEN 0 ELSE (s_c - s_r) * ln(s_c / s_r) END) AS psi
    FROM shares GROUP BY feature),
steps AS (SELECT feature, sum(nr) OVER w AS cr, sum(nc) OVER w AS cc FROM vals
    WINDOW w AS (PARTITION BY feature ORDER BY value)),
stat AS (SELECT s.feature, max(abs(cr / tr - cc / tc)) AS d, any_value(tr)::double AS n,
    any_value(tc)::double AS m FROM steps s JOIN ext ON s.feature = ext.feature GROUP BY s.feature),
ks AS (SELECT feature, d, x, CASE WHEN x < 0.05 THEN 1.0 ELSE least(1.0, greatest(0.0,
    list_sum(list_transform(range(1, 101), lambda k:
      (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0::double * k * k * x * x))))) END AS pv
    FROM (SELECT feature, d, d * sqrt(n * m / (n + m)) AS x FROM stat)),
report AS (SELECT psi.feature, psi, d, pv, psi > 0.2 AS fp, pv < 0.05 AS fk,
    psi > 0.2 OR pv < 0.05 AS dr FROM psi JOIN ks ON psi.feature = ks.feature)"""


REPORT = (
    f"SELECT feature, {r6('psi')} AS psi, {r6('d')} AS ks_statistic, {r6('pv')} AS ks_p_value, "
    "fp AS flag_psi, fk AS flag_ks, dr AS drifted FROM report"
)


def split_rank(source: str, stratum: str, seed: int = 42) -> str:
    """CTE ``ranked``: place of every row in its stratum in hash order."""
    h = f"md5(encounter_id::varchar || ':{seed}') || '|' || encounter_id"
    return f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY {h}) - 1 AS place,
    count(*) OVER (PARTITION BY {stratum}) AS size FROM {source})"""


SPLIT = """CASE WHEN place < floor(size * 0.15::double + 0.5) THEN 'test'
  WHEN place < floor(size * 0.3::double + 0.5) THEN 'val' ELSE 'train' END"""
FOLD = "(" + " + ".join(f"(place >= floor(size * {i / 5!r}::double + 0.5))::int" for i in range(1, 5)) + ")::int"


def contributions() -> str:
    return " UNION ALL ".join(
        f"SELECT encounter_id, {i} AS idx, '{f}' AS feature, "
        f'{c}::double * (coalesce("{f}"::double, {m}::double) - {m}::double) AS v FROM feat'
        for i, (f, c, m) in enumerate(LINEAR)
    )


PHI = f"phi AS ({contributions()})"
FLAGGED = f"flagged AS (SELECT *, (p >= {CUT})::int AS yhat FROM scored)"


def recalls(source: str, columns: list[str]) -> str:
    union = " UNION ALL ".join(
        f"SELECT '{c}' AS group_column, coalesce({c}::varchar, 'nan') AS group_value, y, yhat FROM {source}"
        for c in columns
    )
    return f"""
recalls AS (
  SELECT group_column, group_value, sum(y)::bigint AS n_positive,
    coalesce(sum(y * yhat) / nullif(sum(y), 0), 0) AS recall
  FROM ({union}) GROUP BY ALL),
gaps AS (SELECT group_column, max(recall) - min(recall) AS gap FROM recalls GROUP BY group_column)"""


GROUPS = ["gender", "race", "age_ordinal", "admission_type_id"]
FAIR = (
    f"SELECT r.group_column, group_value, n_positive, {r6('recall')} AS recall, "
    f"{r6('gap')} AS max_recall_gap FROM recalls r JOIN gaps g ON r.group_column = g.group_column"
)

RULES = [
    ("age_ordinal", 0, 9), ("time_in_hospital", 1, 14), ("num_lab_procedures", 0, 132),
    ("num_procedures", 0, 6), ("num_medications", 0, 81), ("number_diagnoses", 1, 16),
    ("num_med_changes", 0, 23), ("num_meds_active", 0, 23), ("total_prior_visits", 0, 100),
    ("insulin_changed", 0, 1), ("high_utilizer", 0, 1), ("medical_specialty_missing", 0, 1),
    ("num_emergency_visits", 0, None), ("num_inpatient_visits", 0, None),
    ("num_outpatient_visits", 0, None), ("lab_procedure_intensity", 0, None),
    ("procedure_intensity", 0, None), ("medication_intensity", 0, None),
    ("diagnosis_complexity", 0, None), ("med_change_ratio", 0, None), ("A1Cresult_abnormal", 0, 1),
    ("diabetesMed_flag", 0, 1), ("change_flag", 0, 1), ("race", None, None),
    ("gender", None, None), ("diag1_category", None, None), ("diag2_category", None, None),
    ("diag3_category", None, None), ("admission_type_id", None, None),
    ("discharge_disposition_grouped", None, None), ("admission_source_grouped", None, None),
]


def broken(name: str, low, high) -> str:
    parts = [f'"{name}" IS NULL']
    if low is not None:
        parts.append(f'"{name}" < {low}')
    if high is not None:
        parts.append(f'"{name}" > {high}')
    return f"CASE WHEN {' OR '.join(parts)} THEN '{name}' END"


def error_list(skip: tuple[str, ...] = ()) -> str:
    return f"list_filter([{', '.join(broken(*rule) for rule in RULES if rule[0] not in skip)}], lambda e: e IS NOT NULL)"


def quantiles(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS count, {r6(f'avg({c})')} AS mean, "
        f"{r6(f'stddev_samp({c})')} AS std, min({c})::double AS min, {r6(f'quantile_cont({c}::double, 0.25)')} AS q25, "
        f"{r6(f'quantile_cont({c}::double, 0.5)')} AS q50, {r6(f'quantile_cont({c}::double, 0.75)')} AS q75, "
        f"max({c})::double AS max FROM {source}"
        for c in columns
    )


def histogram(source: str, columns: list[str], bins: int) -> str:
    """CTEs and select of an equal-width histogram of non-constant columns."""
    return f"""
lv AS (SELECT * FROM ({long(source, columns)}) WHERE value IS NOT NULL),
ext AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM lv GROUP BY feature),
grid AS (SELECT feature, i AS bin, lo + i * ((hi - lo) / {bins}.0::double) AS low,
    CASE WHEN i = {bins - 1} THEN hi ELSE lo + (i + 1) * ((hi - lo) / {bins}.0::double) END AS high,
    i = {bins - 1} AS final FROM ext, range({bins}) AS g(i)),
vals AS (SELECT feature, value, count(*) AS c FROM lv GROUP BY ALL)
SELECT g.feature, g.bin::int AS bin, {r6('any_value(g.low)')} AS low, {r6('any_value(g.high)')} AS high,
  coalesce(sum(c), 0)::bigint AS n
FROM grid g LEFT JOIN vals v ON v.feature = g.feature AND v.value >= g.low
  AND (v.value < g.high OR (g.final AND v.value <= g.high))
GROUP BY g.feature, g.bin"""


FILLED = "WITH {0}, {1}, {2}, med AS (SELECT {3} FROM feat)".format(
    ENC, FIRST, feat("first_enc"), ", ".join(f'quantile_cont("{c}"::double, 0.5) AS "{c}"' for c in NUM)
)
SCALING = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r6('any_value(m)')} AS median, {r6('avg(v)')} AS mean, "
    f"CASE WHEN stddev_pop(v) = 0 THEN 1.0 ELSE {r6('stddev_pop(v)')} END AS scale FROM "
    f"(SELECT coalesce(f.\"{c}\"::double, med.\"{c}\") AS v, med.\"{c}\" AS m FROM feat f, med)"
    for c in NUM
)
CATS = f"SELECT * FROM ({long('feat', CAT, kind='varchar')}) WHERE value IS NOT NULL"
MODES = f"""
levels AS (SELECT feature, value, count(*) AS n FROM ({CATS}) GROUP BY ALL),
modes AS (SELECT feature, value AS mode FROM levels
  QUALIFY row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) = 1)"""


def learned_levels() -> str:
    """Vocabulary of training rows."""
    return f"""{ROWS}, {split_rank('feat', 'readmitted')},
split AS (SELECT *, {SPLIT} AS split FROM ranked),
trained AS (SELECT * FROM split WHERE split = 'train'),
levels AS (SELECT feature, value, count(*) AS n FROM (
    SELECT * FROM ({long('trained', CAT, kind='varchar')}) WHERE value IS NOT NULL) GROUP BY ALL)"""


def one_hot() -> str:
    """Vocabulary and modes of training rows, applied to all rows."""
    return f"""{learned_levels()},
modes AS (SELECT feature, value AS mode FROM levels
  QUALIFY row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) = 1),
cells AS (SELECT l.encounter_id, l.feature, coalesce(l.value, m.mode) AS value
  FROM ({long('split', CAT, 'encounter_id', 'varchar')}) l JOIN modes m ON l.feature = m.feature)
SELECT c.encounter_id, 'cat__' || c.feature || '_' || c.value AS feature, 1 AS value
FROM cells c JOIN levels l ON l.feature = c.feature AND l.value = c.value"""


FOLDS = f"""WITH {ENC}, {SCORED}, {TWO}, {split_rank('scored', 'y')},
folded AS (SELECT t.model, t.p, t.y, {FOLD} AS fold
  FROM ranked r JOIN two t ON r.encounter_id = t.encounter_id),
{curve('folded', 'model, fold')},
fm AS (SELECT model, fold, {AUC} AS roc_auc, {AP} AS pr_auc FROM cum GROUP BY model, fold)"""

NULLABLE = [
    "encounter_id", "patient_nbr", "race", "gender", "age", "weight", "admission_type_id",
    "discharge_disposition_id", "admission_source_id", "time_in_hospital", "payer_code",
    "medical_specialty", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "diag_1", "diag_2", "diag_3",
    "number_diagnoses", "max_glu_serum", "A1Cresult", *MEDS, "change", "diabetesMed", "readmitted",
]
FEATS = ", ".join(
    f'{r6(c)} AS {c}' if c in RATIOS else f'"{c}"' for c in [*NUM, *CAT]
)

ORACLES: dict[str, str] = {
    "csv_scan": f"{W_ENC} SELECT * FROM enc",
    "scored_csv_sink": f"""{W_SCORED} SELECT encounter_id, {r6('round_even(p * 10000, 0) / 10000')} AS risk_score,
        CASE WHEN p < 0.3 THEN 'Low' WHEN p < 0.6 THEN 'Medium' ELSE 'High' END AS risk_tier FROM scored""",
    "preview_rows": f"""{W_ENC} SELECT encounter_id, patient_nbr, race, gender, age, diag_1, readmitted
        FROM enc ORDER BY encounter_id LIMIT 10""",
    "score_requests_scan": f"""{ROWS} SELECT encounter_id, age_ordinal::bigint AS age_ordinal,
        num_lab_procedures, {r6('lab_procedure_intensity')} AS lab_procedure_intensity, race,
        admission_type_id FROM feat""",
    "reference_snapshot": W_SIDES + " SELECT encounter_id, "
        + ", ".join(f'{r6(c)} AS {c}' if c in RATIOS else f'"{c}"' for c in NUM) + " FROM side WHERE NOT cur",
    "drop_low_signal_columns": W_ENC + " SELECT * EXCLUDE (patient_nbr, weight, payer_code, "
        + ", ".join(f'"{m}"' for m in MEDS) + ") FROM enc",
    "clean_encounters": W_ENC + " SELECT * EXCLUDE (patient_nbr, weight, payer_code, medical_specialty, "
        + ", ".join(f'"{m}"' for m in MEDS) + """) REPLACE ((readmitted = '<30')::int AS readmitted,
        admission_type_id::varchar AS admission_type_id),
        (medical_specialty IS NULL)::int AS medical_specialty_missing FROM enc""",
    "contract_fill": f"""{ROWS} SELECT encounter_id, {", ".join(
        f"0 AS {c}" if c in ("num_procedures", "change_flag") else "'Other' AS race" if c == "race"
        else f"{r6(c)} AS {c}" if c in RATIOS else f'"{c}"' for c in [*NUM, *CAT])} FROM feat""",
    "contract_errors": f"""{ROWS} SELECT encounter_id, array_to_string(errors, ',') AS errors,
        len(errors) = 0 AS valid, 0 AS change_flag
        FROM (SELECT encounter_id, {error_list(('change_flag',))} AS errors FROM feat)""",
    "quarantine_counts": f"""{ROWS} SELECT error, count(*) AS n FROM (
        SELECT unnest({error_list()}) AS error FROM feat) GROUP BY error""",
    "nonnull_feature_counts": f"""{ROWS} SELECT feature, count(value) AS n,
        count(DISTINCT value) AS distinct_values FROM ({long('feat', NUM)}) GROUP BY feature""",
    "first_encounters": f"WITH {ENC}, {FIRST} SELECT encounter_id, patient_nbr, readmitted FROM first_enc",
    "code_group_lookup": f"{W_ENC} SELECT encounter_id, admission_source_id, {SOURCE} AS source_group FROM enc",
    "icd_range_join": f"""{W_ENC} SELECT encounter_id, diag_1, c AS by_join, c AS by_case FROM (
        SELECT encounter_id, diag_1, {icd('diag_1', 'n1')} AS c FROM (SELECT *, {DIAG_NUMBERS} FROM enc))""",
    "aligned_predictions": f"{W_SCORED} SELECT encounter_id, y, (p >= {CUT})::int AS yhat, gender, race FROM scored",
    "paired_value_counts": f"""{W_SIDES} SELECT feature, {r6('value')} AS value, (count(*) FILTER (NOT cur))::bigint AS n_ref,
        (count(*) FILTER (cur))::bigint AS n_cur FROM lv GROUP BY feature, lv.value""",
    "diagnosis_features": f"{W_ENC}, {feat('enc')} SELECT encounter_id, diag1_category, diag2_category, diag3_category FROM feat",
    "medication_features": f"{W_ENC}, {feat('enc')} SELECT encounter_id, num_med_changes, num_meds_active, insulin_changed FROM feat",
    "utilization_features": f"""{W_ENC}, {feat('enc')} SELECT encounter_id, num_inpatient_visits AS number_inpatient,
        num_outpatient_visits AS number_outpatient, num_emergency_visits AS number_emergency,
        num_emergency_visits, num_inpatient_visits, num_outpatient_visits, total_prior_visits, high_utilizer FROM feat""",
    "age_feature": f"{W_ENC}, {feat('enc')} SELECT encounter_id, age_ordinal FROM feat",
    "intensity_features": f"{W_ENC}, {feat('enc')} SELECT encounter_id, "
        + ", ".join(f"{r6(c)} AS {c}" for c in RATIOS) + " FROM feat",
    "clinical_flags": f"""{W_ENC}, {feat('enc')} SELECT encounter_id, "A1Cresult_abnormal", "diabetesMed_flag", change_flag FROM feat""",
    "disposition_features": f"""{W_ENC}, {feat('enc')} SELECT encounter_id, discharge_disposition_grouped,
        admission_source_grouped FROM feat""",
    "feature_chain": f"{ROWS} SELECT encounter_id, readmitted, {FEATS} FROM feat",
    "risk_tiers": f"""{W_SCORED} SELECT encounter_id, CASE WHEN p < 0.3 THEN 'Low' WHEN p < 0.6 THEN 'Medium'
        ELSE 'High' END AS risk_tier, (p >= {CUT})::int AS readmitted, {r6('round_even(p * 10000, 0) / 10000')} AS risk_score FROM scored""",
    "run_fingerprint": ROWS + """ SELECT substr(sha256('{"n_train_samples":' || count(*) || ',"positives":'
        || sum(readmitted) || '}'), 1, 12) AS fingerprint FROM feat""",
    "readmission_by_diagnosis": f"""{ROWS} SELECT diag1_category, count(*) AS encounters,
        sum(readmitted)::bigint AS readmitted_30d, {r6('avg(readmitted) * 100')} AS rate_pct
        FROM feat GROUP BY diag1_category""",
    "medians": FILLED + " " + " UNION ALL ".join(f"SELECT '{c}' AS feature, {r6(chr(34) + c + chr(34))} AS median FROM med" for c in NUM),
    "scaling": f"{FILLED} {SCALING}",
    "modes": f"{ROWS}, {MODES} SELECT feature, mode FROM modes",
    "vocabulary": f"{ROWS}, {MODES} SELECT feature, value, n FROM levels",
    "one_hot_long": one_hot(),
    "scaled_long": FILLED + ", " + "cells AS (" + " UNION ALL ".join(
        f"SELECT encounter_id, 'num__{c}' AS feature, (v - avg(v) OVER ()) / stddev_pop(v) OVER () AS value "
        f'FROM (SELECT encounter_id, coalesce(f."{c}"::double, med."{c}") AS v FROM feat f, med)'
        for c in NUM
    ) + f") SELECT encounter_id, feature, {r6('value')} AS value FROM cells WHERE cells.value <> 0",
    "feature_name_table": f"""{ROWS}, {MODES}, names AS (
        SELECT 0 AS part, generate_subscripts({NUM}, 1) AS col, 'num__' || unnest({NUM}) AS name
        UNION ALL SELECT 1, list_position({CAT}, feature), 'cat__' || feature || '_' || value FROM levels)
        SELECT (row_number() OVER (ORDER BY part, col, name) - 1)::int AS idx, name FROM names""",
    "cumulative_counts": f"{W_SCORED}, {curve('scored')} SELECT p, pos, neg, tp, fp FROM cum",
    "best_model_by_score": f"""WITH {ENC}, {TWO}, {curve('two', 'model')}
        SELECT model, {r6(AP)} AS score, CASE WHEN model = 'first' THEN 0 ELSE 1 END AS position
        FROM cum GROUP BY model ORDER BY {AP} DESC, position LIMIT 1""",
    "null_report": W_ENC + ", counts AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count(\"{c}\") AS n_missing, count(*) AS total FROM enc" for c in NULLABLE
    ) + f") SELECT \"column\", n_missing, {r6('round(n_missing / total * 100, 2)')} AS pct FROM counts WHERE n_missing > 0",
    "describe": f"{W_ENC} {quantiles('enc', SUMMARY)}",
    "value_counts": f"{W_ENC} SELECT insulin AS value, count(*) AS n FROM enc WHERE insulin IS NOT NULL GROUP BY insulin",
    "value_shares": f"""{W_ENC}, vals AS (SELECT feature, value, count(*) AS n FROM (
        SELECT * FROM ({long('enc', ['readmitted', 'race', 'gender'], kind='varchar')}) WHERE value IS NOT NULL) GROUP BY ALL)
        SELECT feature, value, n, {r6('n / sum(n) OVER (PARTITION BY feature) * 100')} AS pct FROM vals""",
    "group_rates": f"""{W_ENC}, rates AS (SELECT group_column, group_value, y FROM (
        SELECT 'overall' AS group_column, 'all' AS group_value, (readmitted = '<30')::int AS y FROM enc
        UNION ALL SELECT 'race', race, (readmitted = '<30')::int FROM enc
        UNION ALL SELECT 'gender', gender, (readmitted = '<30')::int FROM enc
        UNION ALL SELECT 'age', age, (readmitted = '<30')::int FROM enc) WHERE group_value IS NOT NULL)
        SELECT group_column, group_value, count(*) AS n, {r6('avg(y) * 100')} AS rate_pct FROM rates GROUP BY ALL""",
    "histogram": f"{W_ENC}, {histogram('enc', SUMMARY, 30)}",
    "event_value_histogram": f"WITH {histogram('events', ['value'], 15)}",
    "correlations": W_ENC + " " + " UNION ALL ".join(
        f"SELECT '{b}' AS a, '{a}' AS b, {r6(f'corr({b}, {a})')} AS r FROM enc"
        for i, a in enumerate(SUMMARY) for b in SUMMARY[i + 1:]
    ),
    "fold_metrics": f"{FOLDS} SELECT model, fold, {r6('roc_auc')} AS roc_auc, {r6('pr_auc')} AS pr_auc FROM fm",
    "fold_summary": f"""{FOLDS} SELECT model, {r6('round(avg(roc_auc), 4)')} AS roc_auc_mean,
        {r6('round(stddev_samp(roc_auc), 4)')} AS roc_auc_std, {r6('round(avg(pr_auc), 4)')} AS pr_auc_mean,
        {r6('round(stddev_samp(pr_auc), 4)')} AS pr_auc_std FROM fm GROUP BY model""",
    "fold_pivot": f"""{FOLDS} SELECT fold, {r6("round(max(pr_auc) FILTER (model = 'first'), 4)")} AS first,
        {r6("round(max(pr_auc) FILTER (model = 'second'), 4)")} AS second FROM fm GROUP BY fold""",
    "tier_counts": f"""{W_SCORED}, t AS (SELECT unnest(['Low', 'Medium', 'High']) AS risk_tier)
        SELECT t.risk_tier, count(s.p) AS n FROM t LEFT JOIN scored s ON t.risk_tier =
        CASE WHEN s.p < 0.3 THEN 'Low' WHEN s.p < 0.6 THEN 'Medium' ELSE 'High' END GROUP BY t.risk_tier""",
    "age_distribution": f"{ROWS} SELECT age_ordinal AS value, count(*) AS n FROM feat GROUP BY age_ordinal",
    "class_balance": f"""{W_SCORED} SELECT count(*) AS n, sum(y)::bigint AS positives, {r6('avg(y)')} AS positive_rate,
        {r6('sum(1 - y) / greatest(sum(y), 1)')} AS positive_weight FROM scored""",
    "roc_auc": f"{W_SCORED}, {curve('scored')} SELECT {r6(AUC)} AS roc_auc FROM cum",
    "average_precision": f"{W_SCORED}, {curve('scored')} SELECT {r6(AP)} AS pr_auc FROM cum",
    "cut_metrics": f"""{W_SCORED}, {curve('scored')} SELECT {r6(PRECISION)} AS precision,
        {r6(RECALL)} AS recall, {r6(F1)} AS f1 FROM cum""",
    "brier_score": f"{W_SCORED} SELECT {r6('avg((p - y) * (p - y))')} AS brier_score FROM scored",
    "all_metrics": f"""{W_SCORED}, {curve('scored')}, m AS (SELECT {AUC} AS roc_auc, {AP} AS pr_auc, {F1} AS f1,
        {PRECISION} AS precision, {RECALL} AS recall, {BRIER} AS brier FROM cum)
        SELECT 'roc_auc' AS metric, {r6('roc_auc')} AS value FROM m UNION ALL SELECT 'pr_auc', {r6('pr_auc')} FROM m
        UNION ALL SELECT 'f1', {r6('f1')} FROM m UNION ALL SELECT 'precision', {r6('precision')} FROM m
        UNION ALL SELECT 'recall', {r6('recall')} FROM m UNION ALL SELECT 'brier_score', {r6('brier')} FROM m""",
}

CUTS = f"""
cuts AS (SELECT 0.01::double + i * 0.01::double AS threshold FROM range(99) AS g(i)),
scan AS (SELECT c.threshold, (count(*) FILTER (s.p >= c.threshold AND y = 1))::bigint AS tp,
    (count(*) FILTER (s.p >= c.threshold))::bigint AS flagged, sum(y)::bigint AS positives
    FROM cuts c, scored s GROUP BY c.threshold),
cutm AS (SELECT *, coalesce(tp / nullif(flagged, 0), 0) AS precision,
    coalesce(tp / nullif(positives, 0), 0) AS recall FROM scan)"""

ORACLES |= {
    "threshold_table": f"""{W_SCORED}, {CUTS} SELECT {r6('threshold')} AS threshold, tp, flagged, positives,
        {r6('precision')} AS precision, {r6('recall')} AS recall FROM cutm""",
    "optimal_threshold": f"""{W_SCORED}, {CUTS} SELECT {r6('threshold')} AS threshold, {r6('precision')} AS precision,
        {r6('recall')} AS recall FROM cutm WHERE recall >= 0.7 ORDER BY cutm.precision DESC, cutm.threshold LIMIT 1""",
    "highest_score_with_recall": f"""{W_SCORED}, {curve('scored')} SELECT {r6('p')} AS threshold,
        {r6('tp / (tp + fp)')} AS precision, {r6('tp / ap')} AS recall FROM cum WHERE tp / ap >= 0.7
        ORDER BY p DESC LIMIT 1""",
    "confusion_matrix": f"""{W_SCORED}, g AS (SELECT a, b FROM range(2) AS x(a), range(2) AS z(b))
        SELECT a::int AS actual, b::int AS predicted, (SELECT count(*) FROM scored s
          WHERE s.y = g.a AND (s.p >= {CUT})::int = g.b) AS n FROM g""",
    "calibration_curve": f"""{W_SCORED}, inner_edges AS (SELECT i * 0.1::double AS edge FROM range(1, 10) AS g(i)),
        b AS (SELECT p, y, (SELECT count(*) FROM inner_edges e WHERE e.edge < s.p) AS bin FROM scored s)
        SELECT bin::int AS bin, {r6('avg(p)')} AS mean_predicted, {r6('avg(y)')} AS fraction_positive,
        count(*) AS n FROM b GROUP BY bin""",
    "roc_points": f"""{W_SCORED}, {curve('scored')} SELECT {r6('fp / an')} AS fpr, {r6('tp / ap')} AS tpr,
        {r6('p')} AS threshold FROM cum UNION ALL SELECT 0.0::double, 0.0::double, NULL""",
    "pr_points": f"""{W_SCORED}, {curve('scored')} SELECT {r6('tp / (tp + fp)')} AS precision,
        {r6('tp / ap')} AS recall, {r6('p')} AS threshold, {r6('ap / (ap + an)')} AS baseline FROM cum
        UNION ALL SELECT 1.0::double, 0.0::double, NULL, {r6('avg(y)')} FROM scored""",
    "quality_gates": f"""{W_SCORED}, {curve('scored')}, m AS (SELECT {AP} AS ap, {RECALL} AS rc, {BRIER} AS br FROM cum)
        SELECT 'min_pr_auc' AS gate, {r6('ap')} AS value, 0.9::double AS bound,
          printf('PR-AUC %.4f below minimum %.4f', ap, 0.9::double) AS message FROM m WHERE ap < 0.9
        UNION ALL SELECT 'min_recall', {r6('rc')}, 0.7::double,
          printf('Recall %.4f below minimum %.4f', rc, 0.7::double) FROM m WHERE rc < 0.7
        UNION ALL SELECT 'max_brier_score', {r6('br')}, 0.1::double,
          printf('Brier score %.4f above maximum %.4f', br, 0.1::double) FROM m WHERE br > 0.1""",
    "subgroup_recall": f"""{W_SCORED}, {FLAGGED}, {recalls('flagged', ['gender'])} SELECT group_column, group_value,
        n_positive, {r6('recall')} AS recall FROM recalls""",
    "fairness_report": f"{W_SCORED}, {FLAGGED}, {recalls('flagged', GROUPS)} {FAIR}",
    "gap_gates": f"""{W_SCORED}, {FLAGGED}, {recalls('flagged', GROUPS)} SELECT group_column,
        {r6('gap')} AS max_recall_gap,
        printf('Subgroup recall gap [%s] %.4f above maximum %.4f', group_column, gap, 0.02::double) AS message
        FROM gaps WHERE gap > 0.02""",
    "document_fairness": f"""WITH d AS (SELECT lang, source, toxic AS y, 1 - quality AS yhat
        FROM labels JOIN documents USING (doc_id)), {recalls('d', ['lang', 'source'])} {FAIR}""",
    "model_comparison": f"""WITH {ENC}, {TWO}, {curve('two', 'model')} SELECT model,
        {r6(f'round({AUC}, 4)')} AS roc_auc, {r6(f'round({AP}, 4)')} AS pr_auc,
        {r6(f"round({at_cut('0.5')[2]}, 4)")} AS f1, {r6(f"round({at_cut('0.5')[0]}, 4)")} AS precision,
        {r6(f"round({at_cut('0.5')[1]}, 4)")} AS recall FROM cum GROUP BY model""",
    "stratified_split": f"""{ROWS}, {split_rank('feat', 'readmitted')} SELECT encounter_id, readmitted,
        {SPLIT} AS split FROM ranked""",
    "train_and_validation_rows": f"""{ROWS}, {split_rank('feat', 'readmitted')} SELECT encounter_id, readmitted, race
        FROM ranked WHERE {SPLIT} <> 'test'""",
    "stratified_folds": f"{ROWS}, {split_rank('feat', 'readmitted')} SELECT encounter_id, readmitted, {FOLD} AS fold FROM ranked",
    "class_weights": f"""{ROWS}, c AS (SELECT readmitted AS label, count(*) AS n FROM feat GROUP BY readmitted)
        SELECT label, n, {r6('(SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n)')} AS weight FROM c""",
    "linear_contributions": f"{ROWS}, {PHI} SELECT encounter_id, idx, feature, {r6('v')} AS contribution FROM phi",
    "top_reasons": f"""{ROWS}, {PHI}, ranked AS (SELECT *, row_number() OVER
        (PARTITION BY encounter_id ORDER BY abs(v) DESC, idx) AS rn FROM phi)
        SELECT encounter_id, (rn - 1)::int AS place, feature, {r6('abs(v)')} AS impact,
        CASE WHEN v > 0 THEN 'increased risk' ELSE 'decreased risk' END AS direction FROM ranked WHERE rn <= 3""",
    "global_importance": f"{ROWS}, {PHI} SELECT feature, {r6('avg(abs(v))')} AS importance FROM phi GROUP BY feature",
    "top_importance": f"""{ROWS}, {PHI} SELECT feature, {r6('avg(abs(v))')} AS importance FROM phi
        GROUP BY feature ORDER BY avg(abs(v)) DESC, feature LIMIT 3""",
    "psi": f"{W_SIDES}, {psi_ks('lv')} SELECT feature, {r6('psi')} AS psi FROM psi",
    "ks_test": f"""{W_SIDES}, {psi_ks('lv')} SELECT feature, {r6('d')} AS ks_statistic,
        {r6('pv')} AS ks_p_value FROM ks""",
    "event_value_ks": f"""WITH ev AS (SELECT 'value' AS feature, value, event_type = 'click' AS cur FROM events
        WHERE value IS NOT NULL AND event_type IS NOT NULL), {psi_ks('ev')} {REPORT}""",
    "user_value_ks": f"""WITH RECURSIVE ev AS (SELECT user_id::varchar AS feature, value, event_type = 'click' AS cur
        FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL AND user_id IS NOT NULL),
    sizes AS (SELECT feature, count(*) FILTER (NOT cur) AS n, count(*) FILTER (cur) AS m FROM ev GROUP BY feature
        HAVING count(*) FILTER (NOT cur) > 0 AND count(*) FILTER (cur) > 0),
    cum AS (SELECT feature, sum(c0) OVER w AS a, sum(c1) OVER w AS b FROM (SELECT feature, value,
        count(*) FILTER (NOT cur) AS c0, count(*) FILTER (cur) AS c1 FROM ev GROUP BY feature, value)
        WINDOW w AS (PARTITION BY feature ORDER BY value)),
    ks AS (SELECT feature, n, m, max(abs(a * m - b * n)) AS h FROM cum JOIN sizes USING (feature) GROUP BY ALL),
    paths AS (SELECT feature, n, m, h, 0 AS s, 0 AS i, 1.0::double AS p FROM ks UNION ALL
        SELECT feature, n, m, h, s + 1, i + step,
            sum(p * CASE WHEN step = 1 THEN n - i ELSE m - (s - i) END / (n + m - s))::double
        FROM paths, (VALUES (0), (1)) AS d(step)
        WHERE s < n + m AND abs((i + step) * m - (s + 1 - i - step) * n) < h
        GROUP BY feature, n, m, h, s, i + step)
    SELECT ks.feature, {r6('ks.h / (ks.n * ks.m)')} AS ks_statistic,
        {r6('1 - coalesce(sum(p), 0)')} AS ks_p_value
    FROM ks LEFT JOIN paths ON paths.feature = ks.feature AND s = ks.n + ks.m GROUP BY ks.feature, ks.h, ks.n, ks.m""",
    "drift_report": f"{W_SIDES}, {psi_ks('lv')} {REPORT}",
    "drift_summary": f"""{W_SIDES}, {psi_ks('lv')} SELECT count(*) FILTER (dr) AS n_features_drifted,
        coalesce(bool_or(dr), false) AS drift_detected FROM report""",
    "drift_check": f"""{W_SIDES}, {psi_ks('lv')} SELECT feature,
        CASE WHEN feature = 'num_procedures' THEN 0.0 ELSE {r6('psi')} END AS psi_score,
        CASE WHEN feature = 'num_procedures' THEN 0.0 ELSE {r6('d')} END AS ks_statistic,
        CASE WHEN feature = 'num_procedures' THEN 1.0 ELSE {r6('pv')} END AS ks_p_value,
        CASE WHEN feature = 'num_procedures' THEN false ELSE dr END AS drifted FROM report""",
}

REQUIRED = ("age_ordinal", "time_in_hospital", "num_lab_procedures", "num_medications", "number_diagnoses",
            "num_med_changes", "num_meds_active", "total_prior_visits", "insulin_changed", "gender")
RECORD_ERRORS = ", ".join(
    broken(*rule) if rule[0] in REQUIRED else broken(*rule).replace(f'"{rule[0]}" IS NULL', "false") for rule in RULES
)
RECORDS = f"""{ROWS}, rec AS (SELECT * REPLACE (
    CASE WHEN encounter_id % 5 <> 0 THEN race END AS race,
    CASE WHEN encounter_id % 5 <> 0 THEN num_procedures END AS num_procedures,
    CASE WHEN encounter_id % 7 <> 0 THEN gender END AS gender,
    CASE WHEN encounter_id % 11 <> 0 THEN time_in_hospital END AS time_in_hospital) FROM feat),
checked AS (SELECT *, encounter_id % 13 = 0 AS cut_off, list_filter([{RECORD_ERRORS}], lambda e: e IS NOT NULL) AS errors FROM rec)
SELECT CASE WHEN NOT cut_off THEN encounter_id END AS encounter_id,
    CASE WHEN NOT cut_off AND len(errors) = 0 THEN coalesce(race, 'Unknown') END AS race,
    CASE WHEN NOT cut_off AND len(errors) = 0 THEN coalesce(num_procedures, 0)::double END AS num_procedures,
    CASE WHEN cut_off THEN '_corrupt_record' ELSE array_to_string(errors, ',') END AS errors,
    NOT cut_off AND len(errors) = 0 AS scored FROM checked"""

VALID = f"SELECT encounter_id FROM (SELECT encounter_id, {error_list()} AS errors FROM feat) WHERE len(errors) = 0"
CONSISTENT = f"""{ROWS} SELECT encounter_id, true AS in_range, true AS decided, true AS tiered, 3::int AS reasons
    FROM ({VALID})"""

ORACLES |= {
    "required_columns": f"{W_ENC} SELECT encounter_id, race FROM enc",
    "batch_size_rule": f"{ROWS} SELECT encounter_id, readmitted FROM feat",
    "selected_columns": ORACLES["feature_chain"],
    "stored_report": ORACLES["all_metrics"],
    "stored_threshold": f"SELECT threshold FROM ({ORACLES['optimal_threshold']})",
    "out_of_fold_scores": f"""{ROWS}, {split_rank('feat', 'readmitted')} SELECT encounter_id, readmitted AS y, 1::bigint AS times,
        true AS in_range FROM ranked WHERE {SPLIT} <> 'test'""",
    "calibrated_scores": f"""{ROWS}, {split_rank('feat', 'readmitted')} SELECT encounter_id, true AS in_range
        FROM ranked WHERE {SPLIT} = 'test'""",
    "evaluation_curves": f"""{ROWS}, {split_rank('feat', 'readmitted')} SELECT count(*) AS binned, count(*) AS counted
        FROM ranked WHERE {SPLIT} = 'test'""",
    "tree_contributions": f"{ROWS} SELECT encounter_id, true AS additive, 1::int AS reasons FROM feat",
    "path_contributions": f"{ROWS} SELECT encounter_id, true AS additive, true AS each_feature_once FROM feat",
    "reloaded_scores": f"{ROWS} SELECT encounter_id, true AS same FROM ({VALID})",
    "model_card": f"""{learned_levels()}
        SELECT 'LogisticRegressionModel' AS model_type, 'check' AS model_version, 0.12::double AS threshold,
        ({len(NUM)} + (SELECT count(*) FROM levels))::int AS n_features, ({len(NUM)} + (SELECT count(*) FROM levels))::int AS named""",
    "explained_row": f"{ROWS} SELECT min(encounter_id) AS encounter_id, 3::int AS reasons, true AS ordered FROM feat",
    "records_scored_with_defaults": RECORDS,
    "batch_scores": CONSISTENT,
    "streamed_scores": CONSISTENT,
    "rejected_requests": f"""{ROWS} SELECT encounter_id, array_to_string(errors, ',') AS errors FROM (
        SELECT encounter_id, {error_list()} AS errors FROM feat) WHERE len(errors) > 0""",
}
