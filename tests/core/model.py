"""A sequential model of the consensus, written from its rules, for property tests."""

import math
import unicodedata

from blockfuse.functions import fixed

PLAIN = str.maketrans("äáàâãöóòôõüúùûéèêëíìîïñçё", "aaaaaooooouuuueeeeiiiincе")


def norm(s):
    s = s.strip().lower().translate(PLAIN).replace("ß", "ss")
    for p in fixed.SAINTS:
        if s.startswith(p):
            s = "st " + s[len(p):]
            break
    out = []
    for c in s:
        if unicodedata.category(c)[0] == "L" or unicodedata.category(c) == "Nd":
            out.append(c)
        elif (c.isspace() or c in "-_") and out and out[-1] != " ":
            out.append(" ")
    return "".join(out).strip()


def translit(s):
    return "".join(fixed.CYRILLIC_LETTERS.get(c, fixed.CYRILLIC_LETTERS.get(c.lower(), c)) for c in s)


def cyr(s):
    return any("Ѐ" <= c <= "ӿ" for c in s)


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    n = max(len(a), len(b))
    return 100 if not n else 100 - (100 * row[-1]) // n


def pair(a, b):
    a, b = norm(a), norm(b)
    if not a or not b:
        return 0
    if a == b:
        return 100
    if cyr(a) != cyr(b):
        c, latin = (a, b) if cyr(a) else (b, a)
        if fixed.CITIES.get(c) == latin:
            return 100
        if translit(c) == latin:
            return 95
        d = lev(translit(c), latin)
        return d - 5 if d >= 88 else 0
    d = lev(a, b)
    if d >= 90:
        return d
    if len(a.encode()) >= 4 and len(b.encode()) >= 4 and (a in b or b in a):
        return 80
    return d - 5 if d >= 70 else 0


def states(a, b):
    a, b = norm(a), norm(b)
    if not a or not b:
        return -1
    if a == b:
        return 100
    if a in b or b in a:
        return 85
    d = lev(a, b)
    return d if d >= 80 else 0


def score(a, b):
    g = 50
    if a["has"] and b["has"]:
        r = math.radians
        h = math.sin(r(b["lat"] - a["lat"]) / 2) ** 2 + math.cos(r(a["lat"])) * math.cos(r(b["lat"])) * math.sin(r(b["lon"] - a["lon"]) / 2) ** 2
        km = 6371.0 * 2 * math.atan2(math.sqrt(h), math.sqrt(1 - h))
        g = next((s for d, s in ((5, 100), (25, 85), (75, 65), (200, 40), (500, 15)) if km < d), 0)
    name = max(
        [pair(a[x], b[y]) for x, y in (("city", "city"), ("ru", "ru"), ("city", "ru"), ("ru", "city")) if a[x] and b[y]], default=0
    )
    post = -1
    if a["postal"] and b["postal"]:
        p, q = (c["postal"].strip().upper().replace(" ", "").replace("-", "") for c in (a, b))
        post = 100 if p == q else 60 if len(p) >= 3 and len(q) >= 3 and p[:3] == q[:3] else 0
    st = states(a["state"], b["state"]) if a["state"] and b["state"] else -1
    parts = [(g, 0.35)]
    if (a["city"] or a["ru"]) and (b["city"] or b["ru"]):
        parts.append((name, 0.30))
    parts += [(x, w) for x, w in ((post, 0.20), (st, 0.15)) if x >= 0]
    total = math.floor(sum(x * w for x, w in parts) / sum(w for _, w in parts) + 0.5)
    level = sum(total >= t for t in (20, 40, 60, 80))
    return level, st


def scrub(s):
    s = s.strip()
    low = s.lower()
    return "" if low in fixed.PLACEHOLDERS or any(p in low for p in fixed.PLACEHOLDER_PARTS) else s


def merge(cands, country):
    valid = []
    for c in cands:
        c = dict(c, city=scrub(c["city"]), ru=scrub(c["ru"]), state=scrub(c["state"]), postal=scrub(c["postal"]))
        if not c["postal"].strip("0 -"):
            c["postal"] = ""
        trust = 100 - 40 * bool(c["country"] and country and c["country"] != country)
        if c["has"]:
            if abs(c["lat"]) < 0.01 and abs(c["lon"]) < 0.01:
                c.update(has=False, lat=0.0, lon=0.0)
                trust -= 25
            elif abs(c["lat"]) > 90 or abs(c["lon"]) > 180:
                c.update(has=False, lat=0.0, lon=0.0)
                trust -= 30
        if c["has"] and country in fixed.BOXES:
            s, n, w, e = fixed.BOXES[country]
            ok = s <= c["lat"] <= n and (c["lon"] >= w or c["lon"] <= e if w > e else w <= c["lon"] <= e)
            trust -= 20 * (not ok)
        if c["has"] and any(abs(c["lat"] - y) < 0.05 and abs(c["lon"] - x) < 0.05 for y, x in fixed.CENTROIDS.get(country, ())):
            c["has"] = False
            trust -= 15
        if c["city"] or c["ru"] or c["postal"] or c["has"]:
            valid.append(dict(c, trust=trust))
    if not valid:
        return dict(country=country, state="", city="", postal="", lat=0.0, lon=0.0, sources=[], confidence=0)
    n = len(valid)
    near = [[j for j in range(n) if j != i and score(valid[i], valid[j])[0] >= 3] for i in range(n)]
    seen, best = set(), None
    for i in range(n):
        if i in seen:
            continue
        queue, comp = [i], []
        seen.add(i)
        while queue:
            x = queue.pop(0)
            comp.append(x)
            for y in near[x]:
                if y not in seen:
                    seen.add(y)
                    queue.append(y)
        key = (len(comp), sum(valid[x]["trust"] for x in comp))
        if best is None or key > best[0]:
            best = (key, comp)
    cluster = [valid[x] for x in best[1]]
    order = fixed.PRIORITY_CIS if country in fixed.CIS else fixed.PRIORITY_ASIA if country in fixed.ASIA else fixed.PRIORITY_DEFAULT
    rank = lambda c: order.index(c["source"]) if c["source"] in order else 100
    p = min(cluster, key=lambda c: (rank(c), -c["trust"]))
    r = {k: p[k] for k in ("country", "state", "city", "postal", "lat", "lon")}
    r["country"] = r["country"] or country
    r["sources"] = [p["source"]]
    for c in cluster:
        if c["source"] == p["source"]:
            continue
        level, st = score(p, c)
        gave = False
        if level >= 3 and not r["city"] and c["city"]:
            r["city"], gave = c["city"], True
        if level >= 2 and not r["state"] and c["state"]:
            r["state"], gave = c["state"], True
        if (level >= 3 or level == 2 and st > 50) and not r["postal"] and c["postal"]:
            r["postal"], gave = c["postal"], True
        if level >= 3 and not (r["lat"] or r["lon"]) and c["has"]:
            r["lat"], r["lon"], gave = c["lat"], c["lon"], True
        if gave:
            r["sources"].append(c["source"])
    inside = {c["source"] for c in cluster}
    for c in valid:
        if c["source"] in inside or c["trust"] < 50:
            continue
        gave = False
        for f in ("postal", "state"):
            if not r[f] and c[f]:
                r[f], gave = c[f], True
        if gave:
            r["sources"].append(c["source"] + "?")
    k = len(cluster)
    s = 25 if k <= 1 else 50 if k == 2 else 65
    s += 5 * (k == n and n >= 2) + 10 * bool(r["city"]) + 5 * bool(r["state"]) + 10 * bool(r["postal"]) + 5 * bool(r["lat"] or r["lon"])
    r["confidence"] = min(100, s)
    return r
