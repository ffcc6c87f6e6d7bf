"""Reading of executed plans."""


def final_lines(plan: str) -> list[str]:
    """Lines of a plan string without the initial plans that adaptive execution prints below the final ones."""
    kept, hidden = [], None
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        if hidden is not None and indent > hidden:
            continue
        hidden = None
        if "== Initial Plan ==" in line:
            hidden = indent
            # Everything as deep as the marker belongs to the initial plan.
            hidden -= 1
            continue
        kept.append(line)
    return kept


def executed_scans(plan: str) -> int:
    """Scans that run: a scan below a reused exchange or subquery is not printed again."""
    lines = final_lines(plan)
    reused, count = None, 0
    for line in lines:
        node = line.lstrip(" :+-")
        indent = len(line) - len(node)
        if reused is not None and indent > reused:
            continue
        reused = indent if node.startswith(("ReusedExchange", "ReusedSubquery")) else None
        count += "FileScan parquet" in node
    return count
