"""DuckDB oracle for the indicator tables.

The display grid is written the plain way here (periods x layout VALUES,
CASE lookups of the field, one conditional aggregate per period for the
pivots), independent of the generator/unpivot form of the Spark plans.  Texts
are rounded on the printed digits of the exact binary value.  Layout rows are
the fixed dimension data from ``weekwise.plans.present``, which the tests hold
to a literal list.
"""

from weekwise.oracle.canon import canon
from weekwise.oracle.click_sql import CLICK_RELATIONS, GROUP_RELATIONS
from weekwise.oracle.fixture_sql import with_fixture
from weekwise.oracle.weekly_sql import RELATIONS, needed
from weekwise.plans.present import GROUP_SUB_ROWS, click_layout, weekly_layout

WEEKS = 8
DASH = "'—'"
# The fixture's periods, as the pivots name them.
WEEKLY_LABELS = ["2025-12-13", "2025-12-20", "2025-12-27", "2026-01-03", "2026-01-10"]
CLICK_LABELS = ["2025-12-13", "2025-12-20", "2025-12-27", "2026-01-03"]
GROUP_LABELS = ["2025-12-13", "2025-12-20", "2025-12-27", "2026-01-03"]


def _q(s: str) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def _values(rows) -> str:
    return ",\n".join("(" + ", ".join(str(v) if isinstance(v, int) else _q(v) for v in r) + ")" for r in rows)


def _fixed(v: str, d: int) -> str:
    """The exact value has no more than the digits printed; what follows the d-th decides."""
    printed = f"format('{{:.80f}}', abs({v}))"
    whole = f"split_part({printed}, '.', 1)"
    kept = f"substr(split_part({printed}, '.', 2), 1, {d})"
    follows = f"substr(split_part({printed}, '.', 2), {d + 1}, 1)"
    n = f"(CAST({whole} || {kept} AS HUGEINT) + CAST({follows} >= '5' AS INTEGER))"
    text = f"lpad(CAST({n} AS VARCHAR), CAST(greatest({d} + 1, length(CAST({n} AS VARCHAR))) AS INTEGER), '0')"
    return f"({text}[:-{d + 1}] || '.' || {text}[-{d}:])" if d else text


def _signed(v: str, d: int) -> str:
    return f"(CASE WHEN {v} < 0 THEN '-' ELSE '' END || {_fixed(v, d)})"


def pct(v: str) -> str:
    x = f"(CAST({v} AS DOUBLE) * 100)"
    return f"{_signed(x, 1)} || '%'"


def growth(v: str) -> str:
    x = f"CAST({v} AS DOUBLE)"
    return f"CASE WHEN {x} >= 0 THEN '+' ELSE '' END || {_signed(f'({x} * 100)', 1)} || '%'"


def lot(v: str) -> str:
    return _signed(f"CAST({v} AS DOUBLE)", 2)


def amount(v: str) -> str:
    x = f"CAST({v} AS DOUBLE)"
    return (f"CASE WHEN {x} < 0 THEN '-' ELSE '' END || "
            f"replace(format('{{:,}}', CAST(floor(abs({x}) + 0.5) AS BIGINT)), ',', '.')")


def text_by(v: str, fmt: str) -> str:
    return (f"coalesce(CASE {fmt} WHEN 'pct' THEN {pct(v)} WHEN 'growth' THEN {growth(v)} "
            f"WHEN 'lot' THEN {lot(v)} WHEN 'amount' THEN {amount(v)} ELSE CAST({v} AS VARCHAR) END, {DASH})")


def label(p: str) -> str:
    return f"CASE WHEN length({p}) = 8 THEN strftime(strptime({p}, '%Y%m%d'), '%Y-%m-%d') ELSE {p} END"


def _case(field: str, columns: dict[str, str]) -> str:
    return f"CASE {field} " + " ".join(f"WHEN {_q(f)} THEN {c}" for f, c in columns.items()) + " END"


def _layout(rows) -> str:
    return ("SELECT * FROM (VALUES " + _values(rows) + ") AS l(row_order, section, metric, comparison, group_label, code, "
            "field, customer_type, fmt)")


def _shown(report: str, column: str, weeks: int) -> str:
    return (f"SELECT {column} AS period FROM {report} WHERE {column} IS NOT NULL GROUP BY ALL "
            f"ORDER BY period DESC LIMIT {weeks}")


def _grid(weeks: int) -> str:
    fields = {r[6]: f"r.{r[6]}" for r in weekly_layout()}
    return f"""
        SELECT row_order, section, metric, comparison, group_label, code, customer_type, fmt, period,
               {label('period')} AS period_label, value, {text_by('value', 'fmt')} AS text,
               CASE WHEN value IS NULL THEN 'null' WHEN fmt = 'growth'
                    THEN CASE sign(value) WHEN 1 THEN 'pos' WHEN -1 THEN 'neg' ELSE 'neu' END END AS cls
        FROM (SELECT l.*, p.period, CAST({_case('l.field', fields)} AS DOUBLE) AS value
              FROM ({_shown('report_derived', 'period', weeks)}) p, ({_layout(weekly_layout())}) l
              LEFT JOIN report_derived r ON r.period = p.period AND r.customer_type = l.customer_type)"""


def _click_grid(weeks: int) -> str:
    def measure(name, kind):
        return f"CAST({_case('l.field', {r[6]: f'r.{r[6]}_{name}' for r in click_layout()})} AS {kind}) AS {name}"

    return f"""
        SELECT row_order, section, metric, comparison, group_label, code, customer_type, period,
               {label('period')} AS period_label, click_rate, clickers, clicks,
               coalesce({pct('click_rate')}, {DASH}) AS rate_text,
               coalesce(CAST(clickers AS VARCHAR), {DASH}) AS clickers_text,
               coalesce(CAST(clicks AS VARCHAR), {DASH}) AS clicks_text
        FROM (SELECT l.*, p.period, {measure('click_rate', 'DOUBLE')}, {measure('clickers', 'BIGINT')},
                     {measure('clicks', 'BIGINT')}
              FROM ({_shown('click_report_derived', 'period', weeks)}) p, ({_layout(click_layout())}) l
              LEFT JOIN click_report_derived r ON r.period = p.period AND r.customer_type = l.customer_type)"""


def _group_grid(weeks: int) -> str:
    subs = _values([r for r in GROUP_SUB_ROWS])

    def measure(at, name, kind):
        return f"CAST({_case('s.sub_order', {r[0]: f'r.{r[at]}' for r in GROUP_SUB_ROWS})} AS {kind}) AS {name}"

    return f"""
        SELECT group_name, sub_order, sub_label, period, {label('period')} AS period_label,
               participants, click_rate, clickers, clicks,
               coalesce(CAST(participants AS VARCHAR), {DASH}) AS participants_text,
               coalesce({pct('click_rate')}, {DASH}) AS rate_text,
               coalesce(CAST(clickers AS VARCHAR), {DASH}) AS clickers_text,
               coalesce(CAST(clicks AS VARCHAR), {DASH}) AS clicks_text
        FROM (SELECT g.group_name, s.sub_order, s.sub_label, p.period, {measure(2, 'participants', 'BIGINT')},
                     {measure(3, 'click_rate', 'DOUBLE')}, {measure(4, 'clickers', 'BIGINT')},
                     {measure(5, 'clicks', 'BIGINT')}
              FROM (SELECT DISTINCT group_name FROM group_derived) g,
                   ({_shown('group_derived', 'award_period', weeks)}) p,
                   (SELECT * FROM (VALUES {subs}) AS v(sub_order, sub_label, c1, c2, c3, c4)) s
              LEFT JOIN group_derived r ON r.award_period = p.period AND r.group_name IS NOT DISTINCT FROM g.group_name)"""


def _pivot(relation: str, keys: str, texts: dict[str, str], labels: list[str]) -> str:
    cells = [f"coalesce(max(CASE WHEN period_label = {_q(p)} THEN {source} END), {DASH}) AS "
             f"\"{p}{'_' + name if len(texts) > 1 else ''}\"" for p in labels for name, source in texts.items()]
    return f"SELECT {keys}, {', '.join(cells)} FROM {relation} GROUP BY {keys}"


_KEYS = "row_order, section, metric, comparison, group_label, code"
WEEKLY_PRESENT = RELATIONS | {
    "grid": _grid(WEEKS), "grid_2": _grid(2), "grid_pivot": _pivot("grid", _KEYS, {"text": "text"}, WEEKLY_LABELS),
    "latest": f"SELECT max(period) AS latest_period, {label('max(period)')} AS latest_period_label FROM report",
}
CLICK_PRESENT = CLICK_RELATIONS | {
    "click_grid": _click_grid(WEEKS), "click_grid_2": _click_grid(2),
    "click_pivot": _pivot("click_grid", _KEYS,
                          {"rate": "rate_text", "clickers": "clickers_text", "clicks": "clicks_text"}, CLICK_LABELS),
}
GROUP_PRESENT = GROUP_RELATIONS | {
    "group_grid": _group_grid(WEEKS), "group_grid_2": _group_grid(2),
    "group_pivot": _pivot("group_grid", "group_name, sub_order, sub_label",
                          {"participants": "participants_text", "rate": "rate_text", "clickers": "clickers_text",
                           "clicks": "clicks_text"}, GROUP_LABELS),
}

# query name -> (relations, the one it reads, numeric columns)
PRESENT_QUERIES = {
    "indicator_long": (WEEKLY_PRESENT, "grid", ["value"]),
    "indicator_long_2_weeks": (WEEKLY_PRESENT, "grid_2", ["value"]),
    "indicator_pivot": (WEEKLY_PRESENT, "grid_pivot", []),
    "latest_period": (WEEKLY_PRESENT, "latest", []),
    "click_indicator_long": (CLICK_PRESENT, "click_grid", ["click_rate"]),
    "click_indicator_long_2_weeks": (CLICK_PRESENT, "click_grid_2", ["click_rate"]),
    "click_indicator_pivot": (CLICK_PRESENT, "click_pivot", []),
    "task_group_long": (GROUP_PRESENT, "group_grid", ["click_rate"]),
    "task_group_long_2_weeks": (GROUP_PRESENT, "group_grid_2", ["click_rate"]),
    "task_group_pivot": (GROUP_PRESENT, "group_pivot", []),
}


def present_oracle(name: str) -> str:
    relations, relation, nums = PRESENT_QUERIES[name]
    return with_fixture(needed(relations, relation) + canon(relation, (), (), nums))
