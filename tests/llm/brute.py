"""Plain Python versions of the contracts, for comparison."""

import hashlib
import re

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(m) -> str:
    return re.sub("[^0-9]", "", m[0])


PII = [("email", EMAIL, lambda m: True),
       ("ip", IP, lambda m: all(int(x) <= 255 for x in m[0].split("."))),
       ("card", CARD, lambda m: 13 <= len(_digits(m)) <= 19 and luhn(_digits(m))),
       ("phone", PHONE, lambda m: 9 <= len(_digits(m)) <= 15)]
SECRETS = [("assign", ASSIGN, lambda m: len(m[2]) >= 8), ("access", ACCESS, lambda m: len(m[0]) >= 16),
           ("hex", HEX, lambda m: len(m[0]) >= 32)]


def spans(text, kinds, by_start=False):
    found = [(k, m.start(), m.end(), i) for i, (k, p, ok) in enumerate(kinds) for m in p.finditer(text or "") if ok(m)]
    return sorted(found, key=lambda x: (x[1], x[3]) if by_start else (x[3], x[1]))


def joined(found) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, _ in found)


def digest(found) -> str:
    return hashlib.sha256(joined(found).encode()).hexdigest()
