"""Reports of small aggregates: JSON, text and a page that filters its issues."""

from __future__ import annotations

import html
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .metrics import PRIORITIES, group_metrics, issue_counts, issue_guide, verdict


def percent(part: int, whole: int) -> str:
    if not whole:
        return "n/a"
    share = 100 * part / whole
    return "<0.01%" if 0 < share < 0.01 else f"{share:.2f}%"


def rendered(c: Column, kind: str) -> Column:
    """A value as text: plain, a numbered list, or turns with their roles."""
    if kind in ("text", "raw"):
        return F.coalesce(c.cast("string"), F.lit(""))
    if kind == "text_list":
        return F.array_join(F.transform(c, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), F.coalesce(x, F.lit("")))), "\n")
    if kind == "serialized_text_list":
        return rendered(F.from_json(c, "array<string>"), "text_list")
    if kind == "dialog_turns":
        return F.array_join(F.transform(c, lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit(": "), F.coalesce(t["content"], F.lit("")))), "\n")
    raise ValueError(f"unknown formatter {kind!r}")


def quality_report(checked: DataFrame, issues: DataFrame, more: DataFrame | None = None, most: int = 200) -> dict:
    """Totals, counts, metrics by split and the first issues. Only aggregates and `most` issues reach the driver.

    issues: all of them; more: those that are not of one checked pair. most: issues to show, all if negative.
    """
    rows = lambda df: [r.asDict() for r in df.collect()]
    guide = sorted(rows(issue_guide(issues)), key=lambda r: (-r["n"], PRIORITIES[r["priority"]], r["code"]))
    in_order = issues.orderBy("split", "row_idx", "pair_ord", "check_ord")
    shown = rows(in_order if most < 0 else in_order.limit(most + 1))
    truncated, shown = 0 <= most < len(shown), shown if most < 0 else shown[:most]
    return {"truncated": truncated, **verdict(checked, more).first().asDict(), "counts": sorted(rows(issue_counts(issues)), key=lambda r: (r["kind"], -r["n"], r["key"])), "splits": rows(group_metrics(checked, "split", more).orderBy("split")), "guide": guide, "issues": shown}


def text_summary(report: dict) -> str:
    return f"{report['verdict']}: {report['checked_pairs']} pairs, {report['errors']} errors, {report['warnings']} warnings ({percent(report['warnings'], report['checked_pairs'])}); {report['recommendation']}"


def cells(rows: list[dict], columns: list[str]) -> str:
    """A table of some columns."""
    line = lambda values, tag: "<tr>" + "".join(f"<{tag}>{html.escape(str(v))}</{tag}>" for v in values) + "</tr>"
    return "<table>" + line(columns, "th") + "".join(line([r.get(c, "") for c in columns], "td") for r in rows) + "</table>"


#: What a reader of the page filters by; issues are shown 50 at a time.
SCRIPT = """
const all = JSON.parse(document.getElementById('data').textContent), pick = {}, size = 50;
let at = 0;
const by = id => document.getElementById(id);
for (const key of ['severity', 'code', 'split', 'field']) {
  const box = by(key);
  for (const value of ['', ...new Set(all.map(x => String(x[key] ?? '')))].sort()) box.add(new Option(value || key, value));
  box.onchange = () => { pick[key] = box.value; at = 0; show(); };
}
by('search').oninput = () => { at = 0; show(); };
by('next').onclick = () => { at += size; show(); };
by('back').onclick = () => { at = Math.max(0, at - size); show(); };
function show() {
  const text = by('search').value.toLowerCase();
  const found = all.filter(x => Object.entries(pick).every(([k, v]) => !v || String(x[k] ?? '') === v) && JSON.stringify(x).toLowerCase().includes(text));
  by('count').textContent = found.length ? `${at + 1} to ${Math.min(at + size, found.length)} of ${found.length}` : 'none';
  by('issues').textContent = found.slice(at, at + size).map(x => [x.severity, x.code, x.split, x.row_idx, x.field, x.message ?? ''].join(' ') + '\\n' + (x.source ?? '') + '\\n' + (x.translation ?? '')).join('\\n\\n');
}
show();
"""


def html_page(report: dict, title: str) -> str:
    """A page of its own: totals, guidance, metrics by split, and issues to filter and to leaf through."""
    data = json.dumps(report["issues"], ensure_ascii=False, default=str).replace("</", "<\\/")
    guide = cells(report["guide"], ["rule", "n", "label", "meaning", "action"])
    splits = cells(report.get("splits", []), ["split", "checked_pairs", "issues", "errors", "warnings", "top_codes"])
    boxes = "".join(f"<select id='{key}'></select>" for key in ("severity", "code", "split", "field"))
    note = "<p>Not all issues are shown.</p>" if report.get("truncated") else ""
    return (
        f"<!DOCTYPE html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><p>{html.escape(text_summary(report))}</p>{guide}{splits}{note}"
        f"{boxes}<input id='search' placeholder='search'><button id='back'>back</button><button id='next'>next</button><span id='count'></span><pre id='issues'></pre>"
        f"<script id='data' type='application/json'>{data}</script><script>{SCRIPT}</script>"
    )
