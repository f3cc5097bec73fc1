"""Write COVERAGE.md: SURVEY §2 inventory ids -> where they are implemented.

Ids are taken from function docstrings ("K-14: ..."), staging spec names and
the registered queries (which carry their inventory id).
"""

from __future__ import annotations

import ast
import os
import re
import sys
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
ID = re.compile(r"\b([IOQSFKATVDX])-(\d{2})\b(?:\.\.([IOQSFKATVDX])-(\d{2}))?")

#: Ids of which a part is not built.
PARTIAL: dict[str, str] = {}


def ids_in(text: str) -> list[str]:
    out = []
    for a, b, _, c in ID.findall(text):
        last = int(c) if c else int(b)
        out += [f"{a}-{i:02d}" for i in range(int(b), last + 1)]
    return out


def main() -> None:
    where: dict[str, set[str]] = defaultdict(set)
    pkg = os.path.join(ROOT, "marginalia")
    for dirpath, _, files in os.walk(pkg):
        for f in sorted(files):
            if not f.endswith(".py"):
                continue
            path = os.path.join(dirpath, f)
            rel = os.path.relpath(path, ROOT)
            tree = ast.parse(open(path).read())
            for node in ast.walk(tree):
                if isinstance(node, ast.FunctionDef):
                    doc = ast.get_docstring(node) or ""
                    first = doc.split("\n", 1)[0]
                    for k in ids_in(first):
                        where[k].add(f"`{rel}:{node.name}`")
    from marginalia.plans import QUERIES
    for name, q in QUERIES.items():
        if q.survey_id:
            where[q.survey_id].add(f"query `{name}` (oracle)" if q.sql else f"query `{name}`")
    from marginalia.operators import staging
    lines = ["# Coverage index", "",
             "Generated by `scripts/coverage_index.py`: SURVEY §2 ids and where they are implemented.", "",
             "| id | implemented by |", "|---|---|"]

    def key(k):
        return (k[0], int(k[2:]))
    for k in sorted(where, key=key):
        lines.append(f"| {k} | {', '.join(sorted(where[k]))}{f' (partial; not built: {PARTIAL[k]})' if k in PARTIAL else ''} |")
    lines += ["", f"Staging contracts (S-01..S-66): {len(staging.SPECS)} specs in `marginalia/operators/staging.py` "
              "plus `orders_clean` (S-04):", "", ", ".join(f"`{n}`" for n in sorted(staging.SPECS)), ""]
    open(os.path.join(ROOT, "COVERAGE.md"), "w").write("\n".join(lines))
    print(len(where), "ids")


if __name__ == "__main__":
    main()
