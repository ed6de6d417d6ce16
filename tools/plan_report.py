"""Write PLANS.md: the final adaptive physical plan of the headline queries.

Each query is run once at sf0.01 (``collect``, so the adaptive plan is
final); the tree keeps operator names and, for exchanges, windows and
joins, their keys.  Attribute ids are stripped.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from logsift.config import local_session  # noqa: E402
from logsift.plans.catalog import QUERIES  # noqa: E402

KEEP_ARGS = ("Exchange", "Window", "Join", "HashAggregate", "SortAggregate", "BroadcastExchange", "Generate")


def condensed(plan: str) -> list[str]:
    out = []
    final = plan.split("== Initial Plan ==")[0]
    for line in final.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        m = re.match(r"^([\s:+\-|]*)(\*\(\d+\) )?([A-Za-z]+)(.*)$", line)
        if not m:
            continue
        indent, codegen, name, rest = m.groups()
        if name in ("AdaptiveSparkPlan", "ShuffleQueryStage", "BroadcastQueryStage", "AQEShuffleRead", "ResultQueryStage"):
            text = f"{indent}{name}"
        elif any(k in name for k in KEEP_ARGS):
            text = f"{indent}{codegen or ''}{name}{rest[:160]}"
        elif name.startswith("FileScan") or name == "Scan":
            cols = re.search(r"\[([^\]]*)\]", rest)
            text = f"{indent}{name} [{cols.group(1) if cols else ''}]"
        else:
            text = f"{indent}{codegen or ''}{name}"
        out.append(text.rstrip())
    return out


def main() -> None:
    sf = os.environ.get("PLAN_SF_DIR", "/root/testdata/sf0.01")
    spark = local_session(8)
    parts = [
        "# Physical plans of the headline queries",
        "",
        f"Final adaptive plans after one run at `{sf}` on `local[8]` (generated by `tools/plan_report.py`).",
        "`*(n)` marks whole-stage code generation; attribute ids are removed.",
        "",
    ]
    for name in HEADLINE:
        df = QUERIES[name](spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = condensed(plan)
        exchanges = sum(1 for ln in lines if "Exchange" in ln and "ReusedExchange" not in ln)
        parts += [f"## {name}", "", f"Exchanges: {exchanges}", "", "```", *lines, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
