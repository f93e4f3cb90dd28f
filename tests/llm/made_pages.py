"""Pages with personal data at known places and look-alikes, made apart from the examples that the model is fitted on."""

import random

SYLLABLES = "ka lo mi ter ven dra so pel ni qua ro ster bin gal tu wex hor fi jun cla".split()
NAMES = "Marta Oskar Li Priya Juan Chloe Ibrahim Anja Tom Yuki".split()


def words(rng, low, high):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(low, high)))


def digits(rng, n):
    return "".join(rng.choice("0123456789") for _ in range(n))


def luhn_digit(body):
    total = sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(body)))
    return str(-total % 10)


def iban(rng, right=True):
    country, letters, n = rng.choice([("DE", "", 18), ("GB", "NWBK", 14), ("FR", "", 23), ("ES", "", 20), ("NL", "INGB", 10), ("AT", "", 16), ("IT", "X", 22)])
    body = letters + digits(rng, n)
    value = int("".join(str(int(c, 36)) for c in body + country + "00"))
    check = 98 - value % 97
    check = check if right else (check + rng.randint(1, 95)) % 97
    whole = f"{country}{check:02d}{body}"
    return " ".join(whole[i : i + 4] for i in range(0, len(whole), 4)) if rng.random() < 0.5 else whole


def real(rng, kind):
    if kind == "email_spelled":
        user, host = rng.choice(NAMES).lower() + rng.choice(["", ".k", digits(rng, 2)]), words(rng, 1, 1) + rng.choice(["", "mail"])
        at, dot = rng.choice([(" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " dot "), (" AT ", " DOT "), ("(at)", "."), (" {at} ", ".")])
        value = f"{user}{at}{host}{dot}{rng.choice(['com', 'org', 'net', 'de', 'fr'])}"
        return rng.choice(["You can reach me by mail, {}", "{}, says the contact page", "Contact: {}", "my address is {} (no spam please)", "Email {} for help"]), value
    if kind == "iban":
        return rng.choice(["Please pay to {}", "IBAN {}", "Bank details: {} with thanks", "Überweisung auf {}", "account {} at the branch", "send rent to {} monthly"]), iban(rng)
    if kind == "ssn":
        value = f"{rng.choice([rng.randint(1, 665), rng.randint(667, 899)]):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}"
        return rng.choice(["SSN {}", "social security number is {}", "Her SSN: {} was on the form", "taxpayer no. {} (W-2)", "Soc. Sec. # {}"]), value
    if kind == "birth_date":
        y, m, d = rng.randint(1935, 2010), rng.randint(1, 12), rng.randint(1, 28)
        value = rng.choice([f"{d:02d}.{m:02d}.{y}", f"{m}/{d}/{y}", f"{y}-{m:02d}-{d:02d}", f"{d:02d}-{m:02d}-{y}"])
        return rng.choice(["born {}", "Date of birth: {}", "DOB {} male", "geboren am {} in Köln", "née le {} à Lyon", "her birthday is {}", "was born on {}"]), value
    if kind == "phone_plain":
        value = rng.choice([f"({digits(rng, 3)}) {digits(rng, 3)}-{digits(rng, 4)}", f"{digits(rng, 3)}-{digits(rng, 3)}-{digits(rng, 4)}", f"{digits(rng, 3)}.{digits(rng, 3)}.{digits(rng, 4)}", f"0{digits(rng, 3)} {digits(rng, 3)} {digits(rng, 4)}"])
        return rng.choice(["call me at {}", "Tel. {}", "phone: {}", "mobile {} after six", "Fax {}", "reach the office by phone, {}", "{} (cell)"]), value
    if kind == "card_grouped":
        body = rng.choice(["4", "51", "37", "6011"])
        body += digits(rng, 15 - len(body))
        number, sep = body + luhn_digit(body), rng.choice("./_")
        return rng.choice(["card {}", "Visa {} expires soon", "my credit card number {}", "charged to {}", "debit {} declined"]), sep.join(number[i : i + 4] for i in range(0, 16, 4))
    value = ":".join(f"{rng.randint(0, 65535):x}" for _ in range(8))
    return rng.choice(["from host {}", "client IP {}", "server {} answered", "address {}", "logged in from {}"]), value


def false(rng, kind):
    if kind == "email_spelled":
        return rng.choice(["we met at {} yesterday", "dinner at {}"]), f"{words(rng, 1, 1)} at {words(rng, 1, 1)}. {words(rng, 1, 1)}"
    if kind == "iban":
        return rng.choice(["serial {}", "part {}", "reference {}", "ticket {}"]), iban(rng, right=False)
    if kind == "ssn":
        return rng.choice(["part no. {}", "order {}", "version {} of the tool", "invoice {}", "isbn {}"]), f"{digits(rng, 3)}-{digits(rng, 2)}-{digits(rng, 4)}"
    if kind == "birth_date":
        return rng.choice(["released on {}", "updated {}", "version of {}", "the meeting of {}", "due {}", "published {}"]), f"{rng.randint(1, 28):02d}.{rng.randint(1, 12):02d}.{rng.randint(1990, 2030)}"
    if kind == "phone_plain":
        return rng.choice(["order {}", "part {}", "isbn {}", "invoice {} paid", "commit {}", "model {}", "score {}"]), f"{digits(rng, 3)}-{digits(rng, 3)}-{digits(rng, 4)}"
    if kind == "card_grouped":
        number = digits(rng, 15)
        number += str((int(luhn_digit(number)) + rng.randint(1, 9)) % 10)
        return rng.choice(["serial {}", "build {}", "section {}", "code {}"]), rng.choice("./_").join(number[i : i + 4] for i in range(0, 16, 4))
    return rng.choice(["mac {}", "time {}", "ratio {}", "at {}"]), ":".join(digits(rng, 2) for _ in range(6))


def pages(kinds, n, seed):
    """(text, {(kind, start, end)}) of n pages with a few places each."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        text, want = "", set()
        for _ in range(rng.randint(1, 5)):
            kind = rng.choice(kinds)
            is_real = rng.random() < 0.5
            frame, value = (real if is_real else false)(rng, kind)
            text += words(rng, 3, 14) + rng.choice([". ", ", ", "\n", " - "])
            before, after = frame.split("{}")
            text += before
            if is_real:
                want.add((kind, len(text), len(text) + len(value)))
            text += value + after + rng.choice([". ", "; ", "\n", " "])
        out.append((text + words(rng, 2, 9), want))
    return out


def measured(scan, kinds, n=1500, seed=21):
    """{kind: (precision, recall)} of added spans; a find is right if it is the place and kind exactly."""
    said, right, wanted = ({k: 0 for k in kinds} for _ in range(3))
    for text, want in pages(kinds, n, seed):
        got = {(k, int(a), int(b)) for k, a, b in (x.split(":") for x in scan(text).split(",") if x) if k in kinds}
        for k, *_ in got:
            said[k] += 1
        for k, *_ in want:
            wanted[k] += 1
        for k, *_ in got & want:
            right[k] += 1
    return {k: (right[k] / max(1, said[k]), right[k] / max(1, wanted[k])) for k in kinds}
