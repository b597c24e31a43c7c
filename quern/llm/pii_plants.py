"""Made-up personal data and look-alikes that are planted into texts, so that a model can be fitted and judged by known spans."""

from __future__ import annotations

import random
import string

HEX, WORD, UPPER = "0123456789abcdef", string.ascii_lowercase, string.ascii_uppercase + string.digits
NAMES = ("jane", "mary", "peter", "li", "ahmed", "olga", "carlos", "j.smith", "anna_k", "info", "sales", "müller", "d.novak77")
HOSTS = ("example", "mail", "post-office", "uni", "acme", "web24", "bücher")
ENDS = ("com", "org", "net", "de", "fr", "es", "io", "edu", "co dot uk")


def _of(rng: random.Random, letters: str, low: int, high: int) -> str:
    return "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))


def _cased(rng: random.Random, x: str) -> str:
    return rng.choice((x, x, x.capitalize(), x.upper()))


def _iban(rng: random.Random) -> str:
    country, body = rng.choice(("DE", "GB", "FR", "ES", "NL")), _of(rng, string.digits, 14, 22)
    check = 98 - int(body + "".join(str(int(c, 36)) for c in country) + "00") % 97
    x = f"{country}{check:02d}{body}"
    return " ".join(x[i : i + 4] for i in range(0, len(x), 4)) if rng.random() < 0.5 else x


def _mixed(rng: random.Random, low: int, high: int) -> str:
    x = _of(rng, string.ascii_letters + string.digits, low, high)
    return x[:-2] + rng.choice(string.digits) + x[-1]


def pick(rng: random.Random, forms: tuple, held: bool):
    """One of the forms: held-out texts use the last ones (a quarter, one at least), which no other text has; one form serves both."""
    keep = max(1, len(forms) // 4) if len(forms) > 1 else 0
    return rng.choice(forms[len(forms) - keep :] if held and keep else forms[: len(forms) - keep])


def value(rng: random.Random, held: bool = False) -> tuple[str, str, str]:
    """A piece of personal data: what stands before it, itself, and what stands after it; held values come in forms of their own."""
    kind = rng.randrange(13)
    if kind <= 3:  # a key and a secret
        key = _cased(rng, pick(rng, ("password", "passwd", "secret", "token", "api_key", "api-key", "my password", "passphrase", "pwd", "access_key", "the passcode"), held))
        sign = pick(rng, ("=", " = ", ": ", " is ", ":", " was "), held)
        quote = rng.choice(("", "", '"', "'"))
        secret = rng.choice((_of(rng, HEX, 16, 64), _mixed(rng, 8, 48), _of(rng, WORD, 4, 8) + _of(rng, string.digits, 1, 4) + rng.choice(("", "!", "#", "$")), _of(rng, UPPER, 12, 40)))
        if sign.strip() in "=:":  # words are secrets after a sign only
            secret = rng.choice((secret, secret, _of(rng, WORD, 6, 14)))
        return f"{key}{sign}{quote}", secret, quote
    if kind == 4:  # secrets whose format speaks for itself
        part = lambda low, high: _of(rng, string.ascii_letters + string.digits + "_-", low, high) + rng.choice(string.ascii_letters)
        return "", pick(rng, ("AKIA" + _of(rng, UPPER, 16, 16), "ghp_" + _of(rng, string.ascii_letters, 36, 36), f"eyJ{part(20, 40)}.eyJ{part(20, 90)}.{part(40, 44)}", "ghp_" + _mixed(rng, 36, 36), "sk_live_" + _mixed(rng, 24, 30)), held), ""
    if kind <= 6:
        at, dot = pick(rng, ((" at ", " dot "), (" [at] ", " [dot] "), ("_at_", "_dot_"), (" AT ", " DOT "), (" (at) ", " (dot) ")), held)
        name = rng.choice([n for n in NAMES if n.isascii()])
        return pick(rng, ("", "", "mail ", "contact: ", "write to "), held), name + at + rng.choice([h for h in HOSTS if h.isascii()]).replace("-", "") + dot + pick(rng, ENDS[:-1], held), ""
    if kind == 7:  # addresses beyond the base format
        return pick(rng, ("", "", "e-mail: ", "contact "), held), f"{pick(rng, ('jörg', 'o’brien', 'señor', 'frédéric'), held)}{rng.choice(('', '.', '_'))}{_of(rng, WORD, 2, 6)}@{rng.choice(HOSTS)}.{pick(rng, ENDS[:-1], held)}", ""
    if kind <= 9:
        lead = pick(rng, ("call ", "phone: ", "Tel. ", "call me on ", "reach us at ", "dial ", "fax ", "mobile ", "ring her on "), held)
        area, mid, end = rng.randint(200, 999), rng.randint(200, 999), f"{rng.randint(0, 9999):04d}"
        return lead, rng.choice((f"{area}-{mid}-{end}", f"{area}.{mid}.{end}", f"({area}) {mid} {end}", f"{area} {mid} {end}", f"0{rng.randint(20, 999)} {rng.randint(1000, 9999)} {rng.randint(100, 9999)}")), ""
    if kind == 10:
        lead = pick(rng, ("ssn ", "account no ", "ID: ", "passport ", "account ", "passport no ", "id number "), held)
        return lead, rng.choice((f"{rng.randint(100, 899)}-{rng.randint(10, 99)}-{rng.randint(0, 9999):04d}", _of(rng, string.digits, 8, 12), f"{rng.randint(10, 99)} {rng.randint(100000, 999999)} {rng.randint(10, 99)}", _of(rng, string.ascii_uppercase, 1, 2) + _of(rng, string.digits, 7, 8))), ""
    if kind == 11:
        d, m, y = f"{rng.randint(1, 28):02d}", f"{rng.randint(1, 12):02d}", rng.randint(1930, 2012)
        return pick(rng, ("born ", "born on ", "date of birth: ", "DOB: ", "birthday "), held), pick(rng, (f"{d}.{m}.{y}", f"{y}-{m}-{d}", f"{m}/{d}/{y}", f"{d}-{m}-{y}"), held), ""
    return pick(rng, ("", "", "IBAN ", "account "), held), _iban(rng), ""


def look_alike(rng: random.Random, held: bool = False) -> str:
    """Something that looks like personal data and is none; held-out texts have kinds of their own."""
    d = rng.randint
    return pick(
        rng,
        (
            f"version {d(1, 30)}.{d(0, 20)}.{d(0, 99)}", f"{d(1990, 2030)}-{d(1, 12):02d}-{d(1, 28):02d}", f"{d(1, 28):02d}.{d(1, 12):02d}.{d(1990, 2030)}", f"at {d(0, 23):02d}:{d(0, 59):02d}:{d(0, 59):02d}",
            f"section {d(1, 20)}.{d(1, 20)}.{d(1, 9)}", f"pages {d(1, 400)}-{d(401, 900)}", f"ISBN 978-{d(0, 9)}-{d(10, 99)}-{d(100000, 999999)}-{d(0, 9)}", f"{d(1, 9)}.{d(0, 10**8):08d}", f"sum of {d(100, 999)} {d(100, 999)} {d(1000, 9999)}",
            rng.choice("_-").join(_of(rng, WORD, 2, 9) for _ in range(d(3, 7))) + rng.choice(("", "_v", "-", "_")) + str(d(1, 99)), f"{_of(rng, WORD, 4, 7) * d(3, 6)}{d(0, 999)}", f"CC BY-NC {d(1, 4)}.0", f"look at {_of(rng, WORD, 3, 7)} dot {_of(rng, WORD, 4, 8)}",
            f"the token = {_of(rng, WORD, 1, 4)}", f"the {rng.choice(('secret', 'password', 'token', 'key'))} {rng.choice(('is', 'was'))} {_of(rng, WORD, 3, 12)}", " ".join(str(d(0, 9)) for _ in range(d(6, 14))), f"{d(1, 254)}-{d(1, 99)}-{d(1, 99)}", f"part {_of(rng, string.ascii_uppercase, 1, 2)}{d(10**6, 10**8)}", "".join(str(d(0, 9)) for _ in range(d(14, 18))),
            f"{d(1, 12)}/{d(1, 28)}/{d(1990, 2030)}", f"{d(1, 9)} {d(100, 999)} {d(100, 999)} units", f"Version {d(1, 9)}.{d(0, 9)}", f"docs/{d(2000, 2030)}/{d(10, 12)}/{_of(rng, WORD, 5, 9)}-{_of(rng, WORD, 4, 9)}-v{d(1, 9)}", f"a secret: {_of(rng, WORD, 2, 5)}", f"{_of(rng, WORD, 3, 6)}@{_of(rng, WORD, 1, 2)}", f"x{d(10, 99)}y{_of(rng, WORD, 12, 20)}",
        ),
        held,
    )


def planted(text: str, rng: random.Random, held: bool = False, values: int = 3, others: int = 5) -> tuple[str, list[tuple[int, int]], list[tuple[int, int]]]:
    """text with values and look-alikes put between its words, and where each stands now."""
    gaps = [i for i, c in enumerate(text) if c == " "] or [len(text)]
    pieces = [(rng.choice(gaps), True, value(rng, held)) for _ in range(values)] + [(rng.choice(gaps), False, ("", look_alike(rng, held), "")) for _ in range(others)]
    out, at, size, true, false = [], 0, 0, [], []
    for gap, real, (before, x, after) in sorted(pieces, key=lambda p: p[0]):
        lead = text[at:gap] + " " + before
        start = size + len(lead)
        (true if real else false).append((start, start + len(x)))
        out += [lead, x, after, " "]
        size, at = start + len(x) + len(after) + 1, gap
    return "".join([*out, text[at:]]), true, false
