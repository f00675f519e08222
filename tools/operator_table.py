"""Print the README table: survey id, functions whose docstring names it, queries."""

import ast
import glob
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from millrace.plans.catalog import CATALOGUE  # noqa: E402


def ids_in(text: str) -> set[str]:
    found = set(re.findall(r"\b([A-Z]\d\d)\b", text))
    for letter, low, high in re.findall(r"\b([A-Z])(\d\d)–[A-Z]?(\d\d)\b", text):
        found |= {f"{letter}{n:02d}" for n in range(int(low), int(high) + 1)}
    return found


def main() -> None:
    functions: dict[str, list[str]] = {}
    for path in sorted(glob.glob(f"{ROOT}/millrace/**/*.py", recursive=True)):
        module = os.path.relpath(path, f"{ROOT}/millrace")[:-3].replace("/", ".")
        if "catalog" in module:
            continue
        for node in ast.walk(ast.parse(open(path).read())):
            if isinstance(node, (ast.FunctionDef, ast.ClassDef)) and not node.name.startswith("_"):
                for i in ids_in(ast.get_docstring(node) or ""):
                    functions.setdefault(i, []).append(f"`{module}.{node.name}`")
    queries: dict[str, list[str]] = {}
    for q in CATALOGUE.values():
        for i in q.ids:
            queries.setdefault(i, []).append(f"`{q.name}`" + ("" if q.sql else "*"))
    order = "SPJAWTUVRKMGXDI"
    print("| id | functions | queries (* = no SQL form) |\n| --- | --- | --- |")
    for i in sorted({*functions, *queries}, key=lambda x: (order.index(x[0]), x)):
        print(f"| {i} | {', '.join(functions.get(i, ['Spark built-in']))} | {', '.join(queries.get(i, ['–']))} |")


main()
