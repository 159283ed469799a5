"""Schema inference on the driver, over a bounded sample of rows."""

from __future__ import annotations

import re
from collections import Counter

from rosterforge.functions import rules as R

_EMAIL = re.compile(r"[^@\s]+@[^@\s]+\.[A-Za-z]{2,}")
_TYPES = (
    ("email", re.compile(r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}")),
    ("ip", re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")),
    ("date", re.compile(r"[0-9]{1,4}[-/][0-9]{1,2}[-/][0-9]{1,4}.*", re.S)),
    ("state", re.compile("|".join(R.STATE_CODES), re.I)),
    ("zip", re.compile(r"[0-9]{5}(?:-[0-9]{4})?")),
    ("gender", re.compile("m|f|male|female", re.I)),
)


def delimiter(lines: list[str], candidates: str = ",\t|;") -> str:
    """The candidate that occurs most; ties and none at all go to the first."""
    text = "\n".join(lines)[:5000]
    return max(candidates, key=text.count)


def encoding(head: bytes) -> str:
    try:
        head.decode("utf-8")
    except UnicodeDecodeError as e:
        if e.start < len(head) - 4:
            return "latin-1"
    return "utf-8"


def is_header(cells: list[str]) -> bool:
    """A first row with a header word in one of its cells and no address in any."""
    low = [c.strip().lower() for c in cells]
    return any(w in c for w in R.HEADER_WORDS for c in low) and not any(_EMAIL.fullmatch(c) for c in low)


def unique_names(cells: list[str]) -> list[str]:
    """Blank headers become column_<i>; repeats get _<i> until they are unique."""
    out: list[str] = []
    for i, c in enumerate(cells):
        name = c.strip() or f"column_{i}"
        while name in out:
            name = f"{name}_{i}"
        out.append(name)
    return out


def map_headers(names: list[str], rows: list[list[str]]) -> dict[str, str]:
    """field -> column: exact spellings, then partial ones, then the column whose cells are addresses, then places around it."""
    low = {n: n.strip().lower() for n in names}
    out: dict[str, str] = {}
    for test in (lambda n, s: n == s, lambda n, s: len(s) > 3 and s in n):
        for field, spellings in R.SYNONYMS.items():
            if field not in out:
                hit = next((n for s in spellings for n in names if n not in out.values() and test(low[n], s)), None)
                if hit is not None:
                    out[field] = hit
    hits = Counter({n: sum(1 for r in rows[:1000] if i < len(r) and _EMAIL.fullmatch(r[i].strip())) for i, n in enumerate(names)})
    best = max(names, key=lambda n: hits[n]) if names else None
    if best and (len(names) == 1 or "email" not in out or (hits[out["email"]] == 0 and hits[best] > 0)):
        out = {f: n for f, n in out.items() if n != best} | {"email": best}
    if out and all(n.startswith("column_") for n in names):
        at = names.index(out["email"])
        places = ["first_name", "last_name"] if at >= 2 else []
        after = ["address", "city", "state", "zipcode", "phone"]
        out |= {f: names[i] for i, f in enumerate(places) if f not in out}
        out |= {f: names[at + 1 + i] for i, f in enumerate(after) if f not in out and at + 1 + i < len(names)}
    return out


def guess_fields(header: list[str]) -> dict[str, int]:
    """field -> place of the first header cell that holds one of its words."""
    low = [h.strip().strip('"').lower() for h in header]
    found = {f: next((i for i, h in enumerate(low) if any(w in h for w in words)), None) for f, words in R.FIELD_WORDS.items()}
    return {f: i for f, i in found.items() if i is not None}


def schema_label(names: list[str], mapping: dict[str, str]) -> str:
    low = {n.strip().lower() for n in names}
    if len(names) == 1:
        return "email_only"
    if low & {"validationstatusid", "emaildomaingroup"}:
        return "validated_data"
    if low & {"carrier", "timezone"}:
        return "mobile_data"
    if {"created on", "ip address"} <= low:
        return "lead_data"
    return "rich_data" if len(mapping) > 5 else "basic_data"


def cell_type(value: str | None) -> str:
    v = (value or "").strip()
    if not v:
        return "empty"
    for name, shape in _TYPES:
        if shape.fullmatch(v):
            return name
    if 7 <= len(re.sub(r"[^0-9]", "", v)) <= 15 and re.fullmatch(r"[0-9\-()\s.]{7,20}", v):
        return "phone"
    return "domain" if v.startswith("http") or any(t in v for t in (".com", ".net", ".org")) else "text"


def column_types(rows: list[list[str]]) -> list[str]:
    """Most frequent type of each column that is not empty; ties go to the first seen."""
    out = []
    for i in range(max(map(len, rows), default=0)):
        seen = Counter(t for r in rows if i < len(r) and (t := cell_type(r[i])) != "empty")
        out.append(seen.most_common(1)[0][0] if seen else "empty")
    return out


def map_types(types: list[str]) -> dict[str, int]:
    """field -> column index from types and places; empty without an e-mail column."""
    if "email" not in types:
        return {}
    at = types.index("email")
    out = {"email": at}
    for kind, field in (("ip", "signup_ip"), ("date", "signup_date"), ("state", "state"), ("zip", "zipcode"), ("gender", "gender"), ("phone", "phone"), ("domain", "signup_domain")):
        if kind in types:
            out[field] = types.index(kind)
    text = [i for i, t in enumerate(types) if t == "text"]
    if at >= 2:
        out |= dict(zip(("first_name", "last_name"), [i for i in text if i < at], strict=False))
    out |= dict(zip(("address", "city"), [i for i in text if i > at], strict=False))
    return out
