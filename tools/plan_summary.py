"""Summarise the physical plan of every analysis query, twice: with the
default broadcast thresholds at sf0.1, and with broadcasts disabled (the
shape the dimension joins take when the tables are too large to broadcast,
as at ~100 TB). Writes a markdown table to stdout.

    python tools/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNTED = {
    "Exchange": r"\bExchange (?!SinglePartition)",
    "BHJ": r"BroadcastHashJoin",
    "SMJ": r"SortMergeJoin",
    "SHJ": r"ShuffledHashJoin",
    "partial agg": r"functions=\[partial_",
    "WindowGroupLimit": r"WindowGroupLimit",
    "TopN": r"TakeOrderedAndProject",
    "Generate": r"\bGenerate\b",
}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def through_one_task(lines: list[str]) -> list[str]:
    """The operator below each single-partition exchange."""
    found = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = re.sub(r"^[\s:|+*()\d-]*", "", lines[i + 1])
            kind = re.match(r"\w+", below)[0]
            detail = re.search(r"keys=\[([^\]]*)\], functions=\[([^\]]*)\]", below)
            if detail and not detail[1]:
                found.append("partial sums (a row a task)")
            elif detail:
                found.append(f"{kind} by {re.sub(r'#[0-9]+L?', '', detail[1])}")
            else:
                found.append(kind)
    return found


def summarise(text: str) -> dict[str, int | str]:
    lines = text.splitlines()
    out: dict[str, int | str] = {name: len(re.findall(pattern, text)) for name, pattern in COUNTED.items()}
    pushed = [
        f for m in re.findall(r"PushedFilters: \[(.*?)\]", text) for f in re.split(r", (?=[A-Z])", m)
        if f and not f.startswith("IsNotNull")
    ]
    out["pushed ranges/equalities"] = "yes" if pushed else ""
    single = through_one_task(lines)
    out["single-partition exchange"] = f"{len(single)}: " + ", ".join(sorted(set(single))) if single else 0
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from quarry.plans.registry import QUERIES as queries
    from quarry.session import get_session

    spark = get_session("local[8]", shuffle_partitions=16)
    rows = []
    for name in sorted(queries):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
        small = summarise(plan_text(queries[name](spark, sf_dir)))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        large = summarise(plan_text(queries[name](spark, sf_dir)))
        rows.append((name, small, large))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
    cols = list(COUNTED) + ["pushed ranges/equalities", "single-partition exchange"]
    print("| query | " + " | ".join(f"{c} (sf0.1 / no broadcast)" for c in cols) + " |")
    print("| --- " * (len(cols) + 1) + "|")
    for name, small, large in rows:
        cells = [f"{small[c]} / {large[c]}" if small[c] != large[c] else f"{small[c]}" for c in cols]
        print(f"| `{name}` | " + " | ".join(str(c) for c in cells) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
