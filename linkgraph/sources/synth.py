"""A generator of test corpora in the three wire formats, with their truth. Seeded; written by the driver, for tests."""

from __future__ import annotations

import csv
import json
import random
from pathlib import Path

GIVEN = "Anna Boris Clara Dmitri Elena Felix Greta Hugo Irina Jakob Katya Leon Marta Nikolai Olga Pavel Rosa Stefan Tanya Viktor".split()
FAMILY = "Abramov Bauer Costa Dubois Eriksen Fischer Garcia Horvat Ivanov Jensen Kowalczyk Larsen Moreau Novak Orlov Petrov Rossi Sokolov Tanaka Weber Zielinski Shevchenko".split()
WORDS = "Amber Birch Cobalt Delta Ember Falcon Granite Harbour Indigo Juniper Krypton Lantern Meridian Nimbus Orchid Pioneer Quartz Raven Summit Tundra".split()
TRADES = "Trading Logistics Capital Energy Foods Marine Software Textiles".split()
FORMS = ["Limited", "Ltd", "PLC", "LLP", "Limited"]
FOREIGN = [("Cyprus", "Ltd"), ("British Virgin Islands", "Ltd"), ("Luxembourg", "S.A.R.L."), ("Germany", "GmbH"), ("Russia", "OOO")]
DOUBLETS = {"Kowalczyk": "Kowalchyk", "Shevchenko": "Schevchenko", "Petrov": "Petroff", "Sokolov": "Sokoloff", "Zielinski": "Zielinsky", "Ivanov": "Ivanoff"}
BANDS = ["25-to-50", "50-to-75", "75-to-100"]


def corrupted(first: str, last: str, rng: random.Random, difficulty: float) -> tuple[str, str, list[str]]:
    """A person's names as another filing might have them, and what was done."""
    done = []
    if last in DOUBLETS and rng.random() < 0.4 * difficulty:
        last = DOUBLETS[last]
        done.append("transliteration")
    if len(last) > 4 and rng.random() < 0.18 * difficulty:
        k = rng.randrange(1, len(last) - 1)
        last = last[:k] + last[k + 1] + last[k] + last[k + 2 :]
        done.append("typo")
    if rng.random() < 0.1 * difficulty:
        first, last = last, first
        done.append("swap")
    if rng.random() < 0.12 * difficulty:
        last = last.upper()
        done.append("upper")
    return first, last, done


def generate(folder: str | Path, companies: int = 300, people: int = 120, sanctioned: int = 25, difficulty: float = 0.6, seed: int = 1234) -> dict[str, str]:
    """Writes companies.csv, filings.jsonl, sanctions.jsonl and truth.json into a local folder; returns their paths."""
    rng, folder = random.Random(seed), Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    register = []
    for k in range(companies):
        name = f"{rng.choice(WORDS)} {rng.choice(TRADES)} {rng.choice(FORMS)}" if k % 4 else f"{rng.choice(WORDS)} {rng.choice(WORDS)} {k} {rng.choice(FORMS)}"
        number = f"SC{k + 1:06d}" if rng.random() < 0.08 else f"{k + 1:08d}"
        register.append({"CompanyName": name, "CompanyNumber": number, "RegAddress.AddressLine1": f"{rng.randrange(1, 99)} High Street", "RegAddress.PostTown": "London", "RegAddress.PostCode": f"EC{rng.randrange(1, 5)}V {rng.randrange(1, 9)}NR", "CompanyStatus": "Active", "IncorporationDate": f"0{rng.randrange(1, 9)}/03/{rng.randrange(1990, 2020)}", "SICCode.SicText_1": "62012 - Software"})
    with (folder / "companies.csv").open("w", newline="") as f:
        w = csv.DictWriter(f, [*register[0]] if register else ["CompanyNumber"])
        w.writeheader()
        w.writerows(register)
    filings, clusters, log, links, sanctions, os_links = [], {}, [], {}, [], {}
    used: set[tuple] = set()
    for p in range(people):
        while True:
            first, last, year, month = rng.choice(GIVEN), rng.choice(FAMILY), rng.randrange(1940, 2000), rng.randrange(1, 13)
            if (first, last, year) not in used:
                used.add((first, last, year))
                break
        nationality, postcode = rng.choice(["British", "Russian", "German", "Polish"]), f"SW{rng.randrange(1, 9)}A {rng.randrange(1, 9)}AA"
        ids = []
        for n in range(rng.choices([1, 2, 3, 4, 5, 8], [38, 26, 16, 10, 6, 4])[0]):
            a, b, done = corrupted(first, last, rng, difficulty)
            target = rng.choice(register)["CompanyNumber"]
            title = rng.random() < 0.75
            data = {"kind": "individual-person-with-significant-control", "name": f"{'Mr ' if title else ''}{a} {b}", "nationality": nationality, "address": {"premises": str(10 + p), "address_line_1": "Park Road", "postal_code": postcode}, "natures_of_control": [f"ownership-of-shares-{rng.choice(BANDS)}-percent"], "notified_on": "2016-04-06", "links": {"self": f"/company/{target}/psc/individual/p{p}n{n}"}}
            if rng.random() > 0.15:
                data["name_elements"] = {"forename": a, "surname": b}
            if rng.random() > 0.05:
                data["date_of_birth"] = {"year": year, "month": month}
            if rng.random() < 0.06:
                data["ceased_on"] = "2020-01-01"
            filings.append({"company_number": target, "data": data})
            ids.append(f"ch:psc:{target}:p{p}n{n}")
            log.append({"record_id": ids[-1], "corruptions": done + ["title"] * title})
        clusters[f"TRUE-P-{p:05d}"] = ids
        if p < sanctioned:
            sanctions.append({"id": f"S{p}", "caption": f"{first} {last}", "schema": "Person", "properties": {"name": [f"{first} {last}"], "alias": [f"{first} {DOUBLETS[last]}"] if last in DOUBLETS else [], "birthDate": [f"{year}-{month:02d}"], "topics": ["sanction"], "nationality": [nationality]}, "datasets": ["made"]})
            os_links[f"os:S{p}"] = f"TRUE-P-{p:05d}"
    for k, c in enumerate(register):
        if rng.random() < 0.22:
            rid = f"ch:psc:{c['CompanyNumber']}:c{k}"
            if rng.random() < 0.55:
                parent = rng.choice(register)
                who = {"name": parent["CompanyName"].upper(), "identification": {"country_registered": "England", "registration_number": parent["CompanyNumber"] if rng.random() < 0.7 else ""}}
                if who["identification"]["registration_number"]:
                    links[rid] = f"ch:company:{parent['CompanyNumber']}"
            else:
                country, form = rng.choice(FOREIGN)
                who = {"name": f"{rng.choice(WORDS)} Holdings {form}", "identification": {"country_registered": country, "registration_number": f"HE{k}"}}
            how = rng.choice(["ownership-of-shares-75-to-100-percent", "right-to-appoint-and-remove-directors-as-trust", "ownership-of-shares-25-to-50-percent-as-firm"])
            filings.append({"company_number": c["CompanyNumber"], "data": {"kind": "corporate-entity-person-with-significant-control", **who, "natures_of_control": [how], "notified_on": "2017-01-01", "links": {"self": f"/company/{c['CompanyNumber']}/psc/corporate/c{k}"}}})
        elif rng.random() < 0.05:
            filings.append({"company_number": c["CompanyNumber"], "data": {"kind": "persons-with-significant-control-statement", "statement": "no-individual-or-entity"}})
    (folder / "filings.jsonl").write_text("\n".join(map(json.dumps, filings)))
    (folder / "sanctions.jsonl").write_text("\n".join(map(json.dumps, sanctions)))
    (folder / "truth.json").write_text(json.dumps({"person_clusters": clusters, "corporate_links": links, "sanctions_links": os_links, "corruption_log": log, "params": {"companies": companies, "people": people, "sanctioned": sanctioned, "difficulty": difficulty, "seed": seed}}))
    return {k: str(folder / f) for k, f in (("companies", "companies.csv"), ("filings", "filings.jsonl"), ("sanctions", "sanctions.jsonl"), ("truth", "truth.json"))}
