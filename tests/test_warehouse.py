"""The whole warehouse on a small world: a first load, two later ones, and repeats."""

import datetime

import domain
import pytest
from pyspark.sql import functions as F

from snowloom import sinks
from snowloom.operators import quality
from snowloom.plans import conforming, staging, warehouse
from snowloom.plans import dataset as wide

DAY1, DAY2, DAY3 = datetime.date(2022, 12, 19), datetime.date(2022, 12, 26), datetime.date(2023, 1, 2)


def rows(df, *columns, where=None):
    df = df if where is None else df.where(where)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def one(df, *columns, where):
    found = rows(df, *columns, where=where)
    assert len(found) == 1, found
    return found[0]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """State after each load: the ids and counts that later tests compare."""
    home = tmp_path_factory.mktemp("sources")
    sinks.ensure_database(spark, "stg")
    for name in domain.CODE_LISTS:
        staging.land_code_list(spark, name, domain.write_json(f"{home}/{name}", name), f"stg.{name}")
    state = {}

    def files(day, countries, laureates):
        return (
            domain.write_csv(f"{home}/countries{day}", domain.COUNTRY_HEADER, countries),
            domain.write_csv(f"{home}/laureates{day}", domain.LAUREATE_HEADER, laureates),
        )

    def land(day, countries, cities, laureates):
        country_file, laureate_file = files(day, countries, laureates)
        staging.land_countries(spark, country_file, "stg.countries", day)
        staging.land_cities(spark.createDataFrame(cities, domain.CITY_SCHEMA), "stg.cities", day)
        staging.land_laureates(spark, laureate_file, "stg.laureates", day)
        return country_file, laureate_file

    def snapshot(w):
        tables = ["countries_uptodate", "cities_uptodate", "organizations", "laureate_persons", "persons_in_orgs",
                  "nobel_prizes", "dataset", "countries", "cities", "societies", "prize_types", "organization_places"]
        return {t: [r.asDict() for r in w[t].collect()] for t in tables}

    paths = land(DAY1, domain.COUNTRIES, domain.CITIES, domain.LAUREATES)
    state["files"] = dict(zip(("countries", "laureates"), paths))
    w = warehouse.run(spark, "stg", "dwh", DAY1)
    state["first"] = snapshot(w)
    w = warehouse.run(spark, "stg", "dwh", DAY1)
    state["nothing new"] = snapshot(w)
    # The first batch is landed a second time before the next run.
    land(DAY1, domain.COUNTRIES, domain.CITIES, domain.LAUREATES)
    land(DAY2, domain.COUNTRIES_2, domain.CITIES_2, domain.LAUREATES_2)
    w = warehouse.run(spark, "stg", "dwh", DAY2)
    state["second"] = snapshot(w)
    w = warehouse.run(spark, "stg", "dwh", DAY3)
    state["empty delta"] = snapshot(w)
    state["w"] = w
    return state


def test_landing_keeps_bad_values_out(spark, loaded):
    assert spark.table("stg.laureates").where("birth_date is null").count() == 3
    assert rows(spark.table("stg.countries"), "climate", where="country_name = 'Sweden '") == [(None,), (None,)]
    assert one(spark.table("stg.laureates"), "motivation", where="laureate_id = 1") == ('"for work 1, part 1"',)


def test_audit_of_files(spark, loaded):
    found = warehouse.audit_files(spark, loaded["files"])
    assert rows(found["laureates"], "column_name", "bad_casts", "too_long") == [("birth_date", 1, 0)]
    assert rows(found["countries"], "column_name", "bad_casts", "too_long") == [("climate", 1, 0)]


def test_audits_are_clean(loaded):
    findings = {name: rows(df, *df.columns) for name, df in warehouse.audit(loaded["w"]).items()}
    assert {name: found for name, found in findings.items() if found} == {}


def test_audit_scans_every_table_once(spark, loaded):
    w = loaded["w"]
    assert warehouse.audit_once(w).collect() == []
    # A prize of nobody, twice, and a country without a name.
    names = {c.table for c in warehouse.checks()} | {p for c in warehouse.checks() for p, _ in c.parents}
    frames = {name: w[name] for name in names}
    prize = frames["nobel_prizes"].limit(1).withColumn("laureate_id", F.lit(999)).withColumn("year", F.lit(1))
    frames["nobel_prizes"] = frames["nobel_prizes"].union(prize).union(prize)
    frames["countries_uptodate"] = frames["countries_uptodate"].withColumn("country_name", F.nullif("country_name", F.lit("Poland")))
    found = {(r.table_name, r.kind, r.column_names): (r.key, r.n) for r in quality.audit_tables(frames, warehouse.checks()).collect()}
    assert found["nobel_prizes", "reference", "laureate_id"] == ('["999"]', 2)
    assert found["nobel_prizes", "unique", "nobel_prize_id"][1] == 3
    assert found["countries_uptodate", "required", "country_id,country_name"] == ("country_name", 1)
    assert len(found) == 4


def test_country_ids_and_parents(loaded):
    first = {r["country_name"]: r for r in loaded["first"]["countries_uptodate"]}
    listed = sorted(n for n in first if first[n]["country_id"] < 16)
    # 13 listed and 3 missing names come first, by name; 63 historical ones follow.
    assert [first[n]["country_id"] for n in listed] == list(range(16))
    assert "South Korea" in listed and "Hong Kong" in listed and "Antarctica" in listed
    assert len(first) == 16 + 63
    assert sorted(r["country_id"] for r in first.values()) == list(range(79))
    assert first["Prussia (Poland)"]["parent_country_id"] == first["Poland"]["country_id"]
    assert first["Union of Soviet Socialist Republics"]["parent_country_id"] == first["Russia"]["country_id"]
    assert first["East Germany"]["parent_country_id"] == first["Germany"]["country_id"]
    assert first["Persia (Iran)"]["parent_country_id"] is None
    assert first["Poland"]["parent_country_id"] is None


def test_country_attributes(loaded):
    w = loaded["w"]
    continents = {r["continent_code"]: r["continent_id"] for r in w["continents"].collect()}
    first = {r["country_name"]: r for r in loaded["first"]["countries_uptodate"]}
    assert one(w["continents"], "continent_name", where="continent_code = '??'") == ("",)
    assert first["Gaza Strip"]["continent_id"] == continents["AS"]
    assert first["Netherlands Antilles"]["continent_id"] == continents["NA"]
    assert first["Gaza Strip"]["capital_name"] == "East Jerusalem"
    assert first["Scotland"]["capital_name"] == "Edinburgh"
    assert first["Antarctica"]["capital_name"] is None
    assert first["Germany"]["capital_name"] == "Berlin"
    assert first["Antarctica"]["region_id"] is None


def test_country_codes(loaded):
    w = loaded["w"]
    codes = {r["iso2_code"]: r for r in w["country_codes"].collect()}
    assert len(codes) == 17
    # No phone or no currency must not lose the code.
    assert codes["SE"]["phone_code"] is None and codes["SE"]["currency_code_id"] is not None
    assert codes["TR"]["currency_code_id"] is None and codes["TR"]["phone_code"] == "90"
    assert codes["AQ"]["currency_code_id"] is None
    assert codes["DE"]["currency_code_id"] == codes["FR"]["currency_code_id"]
    pairs = rows(w["code_country_names"], "iso2_code", "country_name")
    assert ("PS", "Gaza Strip") in pairs and ("PS", "West Bank") in pairs
    assert [c for c, n in pairs if n.startswith("Netherlands")] == ["BQ", "CW", "SX"]
    assert rows(w["codes_in_countries"], "code_in_country_id") == sorted(
        [(i,) for i in range(len(pairs))], key=repr
    )


def test_cities(loaded):
    names = {r["country_id"]: r["country_name"].strip() for r in loaded["first"]["countries_uptodate"]}
    first = loaded["first"]["cities_uptodate"]
    place = {r["accent_city_name"]: names.get(r["country_id"]) for r in first}
    assert place["Gaza"] == place["Boundary"] == "Gaza Strip"
    assert place["Hebron"] == "West Bank"
    assert place["Nowhere"] is None and place["Orphan"] is None
    assert place["Kralendijk"] == place["Willemstad"] == "Netherlands Antilles"
    assert "Duptown" not in place
    assert sorted(r["city_id"] for r in first) == list(range(26))
    # Two cities of one name and region in one list both stay.
    assert sum(r["accent_city_name"] == "Neustadt" for r in first) == 3


def test_city_history(loaded):
    first = {(r["accent_city_name"], r["latitude"]): r for r in loaded["first"]["cities_uptodate"]}
    second = {(r["accent_city_name"], r["latitude"]): r for r in loaded["second"]["cities_uptodate"]}
    assert all(second[k]["city_id"] == r["city_id"] for k, r in first.items())
    assert {k[0] for k in second if k not in first} == {"Rome"}
    berlin = next(r for k, r in second.items() if k[0] == "Berlin")
    assert berlin["population"] == 3500000 and berlin["upd_date"] == DAY2
    newark = next(r for k, r in second.items() if k[0] == "Newark")
    assert newark["upd_date"] == DAY1
    assert len(loaded["second"]["cities"]) == 26 + 26


def test_persons(loaded):
    w = loaded["w"]
    cities = {r["city_id"]: r for r in loaded["second"]["cities_uptodate"]}
    persons = {r["laureate_id"]: r for r in loaded["first"]["laureate_persons"]}
    birth = {i: cities[p["birth_city_id"]]["accent_city_name"] for i, p in persons.items() if p["birth_city_id"] is not None}
    assert birth[1] == "Breslau" and birth[2] == "Krakow" and birth[4] == "Munich" and birth[17] == "Leningrad"
    assert birth[9] == birth[10] == "Springfield" and persons[9]["birth_city_id"] != persons[10]["birth_city_id"]
    assert 12 not in birth and 18 not in birth
    assert cities[persons[12]["death_city_id"]]["accent_city_name"] == "Munich"
    german = [r["city_id"] for r in cities.values() if r["accent_city_name"] == "Neustadt" and r["city_region"] == "02"]
    polish = [r["city_id"] for r in cities.values() if r["accent_city_name"] == "Neustadt" and r["city_region"] == "79"]
    assert persons[14]["birth_city_id"] == min(german) and [persons[14]["death_city_id"]] == polish
    assert persons[12]["birth_country_id"] is None
    assert 3 not in persons
    genders = {r["gender"]: r["gender_id"] for r in w["genders"].collect()}
    assert set(genders) == {"Male", "Female"} and persons[2]["gender_id"] == genders["Female"]


def test_organizations(loaded):
    second = loaded["second"]
    named = {(r["organization_name"], r["organization_city"]): r["organization_id"] for r in second["organization_places"]}
    organizations = {r["organization_id"]: r for r in second["organizations"]}

    def parent(*key):
        return organizations[named[key]]["parent_organization_id"]

    assert parent("Bell Laboratories", "Holmdel, NJ") == named["Bell Laboratories", "Murray Hill, NJ"]
    assert parent("Bell Laboratories", "Murray Hill, NJ") is None
    assert parent("Duke University Medical Center", "Durham, NC") == named["Duke University", "Durham, NC"]
    assert parent("University of California", "Los Angeles, CA") == named["University of California", "Berkeley, CA"]
    assert parent("University of California", "Berkeley, CA") is None
    assert ("Howard Hughes Medical Institute", "Durham, NC") in named
    countries = {r["country_id"]: r["country_name"].strip() for r in second["countries_uptodate"]}
    pasteur = organizations[named["Institut Pasteur", "Tunis"]]
    assert countries[pasteur["organization_country_id"]] == "Tunisia"
    first = {(r["organization_name"], r["organization_city"]): r["organization_id"] for r in loaded["first"]["organization_places"]}
    assert all(named[k] == v for k, v in first.items()) and len(named) == len(first)
    newest = {r["organization_name"]: r["upd_date"] for r in second["organizations"]}
    assert newest["A Institute"] == DAY2 and newest["C Institute"] == DAY1


def test_societies_and_prizes(loaded):
    society, = loaded["second"]["societies"]
    assert (society["laureate_id"], society["society_name"], society["upd_date"]) == (3, "Red Cross", DAY2)
    first, second = loaded["first"]["nobel_prizes"], loaded["second"]["nobel_prizes"]
    assert sorted(r["nobel_prize_id"] for r in first) == list(range(20))
    # Two new prizes; the late second place of laureate 5 is no new prize.
    assert sorted(r["nobel_prize_id"] for r in second) == list(range(22))
    assert sum(r["laureate_id"] == 8 for r in second) == 2
    assert len(loaded["second"]["persons_in_orgs"]) == len(loaded["first"]["persons_in_orgs"]) + 2


def test_dataset(loaded):
    first = {(r["laureate_id"], r["year"]): r for r in loaded["first"]["dataset"]}
    second = {(r["laureate_id"], r["year"]): r for r in loaded["second"]["dataset"]}
    assert len(first) == 20 and len(second) == 22

    def names(row):
        return [row[f"organization_name{i}"] for i in (1, 2, 3)]

    assert names(first[5, 1951]) == ["A Institute", "C Institute", None]
    assert names(second[5, 1951]) == ["A Institute", "B Institute", "C Institute"]
    assert second[5, 1951]["upd_date"] == DAY2
    assert names(first[7, 1953]) == ["A Institute", "B Institute", "C Institute"]
    assert names(first[4, 1950]) == [None, None, None]
    assert names(first[3, 1917]) == [None, None, None] and first[3, 1917]["society_name"] == "Red Cross"
    assert first[3, 1917]["laureate_person_name"] is None and first[3, 1917]["laureate_gender"] is None
    parent = first[1, 1918]
    assert parent["birth_country_name"] == "Prussia (Poland)" and parent["birth_country_parent_name"] == "Poland"
    assert parent["birth_country_population"] == 38536869 and parent["birth_continent_name"] == "EUROPE"
    assert parent["birth_region_name"] == "EASTERN EUROPE" and parent["birth_city_population"] == 630000
    assert first[4, 1950]["birth_country_parent_name"] == "Germany"
    assert first[12, 1963]["birth_country_parent_name"] == "Nowhereland"
    assert first[12, 1963]["death_city_region"] == "02" and first[12, 1963]["death_country_gdb"] == 27600
    holmdel = first[9, 1960]
    assert holmdel["organization_parent_name1"] == "Bell Laboratories"
    assert holmdel["organization_city_population1"] == 2000 and holmdel["organization_region_name1"] == "NORTHERN AMERICA"
    assert first[11, 1962]["organization_parent_name1"] == "Duke University"
    assert first[16, 1928]["organization_country_name1"] == "Tunisia"
    assert (8, 1903) in first and (8, 1911) in first


def test_wide_table_by_laureate_alone(spark, loaded):
    """The other grain: one row per laureate, the prizes of one laureate collapsed."""
    w = loaded["w"]
    rows_ = conforming.conform_laureates(w.listed("laureates"))
    frames = [w[t] for t in ("laureate_persons", "organization_places", "organizations", "countries_uptodate",
                             "cities_labelled_uptodate", "regions", "continents")]
    got = {r["laureate_id"]: r for r in wide.dataset(rows_, *frames, keys_=["laureate_id"]).collect()}
    assert len(got) == w["laureate_persons"].count() + 1
    assert (got[8]["year"], got[8]["category"], got[8]["prize"]) == (1903, "Chemistry", "Prize in Chemistry 1911")
    assert got[3]["year"] == 1917 and got[3]["upd_date"] == DAY2


def test_old_states_are_dropped(spark, loaded):
    """There were two commits, so nothing could go yet; a third lets the first one's go, see the last test."""
    assert loaded["w"].tables.number == 2
    assert len(sinks.versions(spark, "dwh.organizations")) == 2


def test_the_state_before_a_run_stays(spark, loaded):
    first = sinks.at(spark, "dwh", 1)
    for table in ("dataset", "countries_uptodate", "nobel_prizes", "organizations", "cities", "cities_uptodate"):
        assert first.frame(table).count() == len(loaded["first"][table])
        assert spark.table(f"dwh.{table}").count() == len(loaded["second"][table])


def test_runs_without_news_change_nothing(loaded):
    assert {t: sorted(map(repr, r)) for t, r in loaded["nothing new"].items()} == {
        t: sorted(map(repr, r)) for t, r in loaded["first"].items()
    }
    assert {t: sorted(map(repr, r)) for t, r in loaded["empty delta"].items()} == {
        t: sorted(map(repr, r)) for t, r in loaded["second"].items()
    }


def test_copy_in_declared_layouts(spark, loaded):
    warehouse.copy_out(loaded["w"], "mart")
    w = loaded["w"]
    for table in ("dataset", "cities", "organizations", "genders"):
        assert spark.table(f"mart.{table}").count() == w[table].count()
    described = {r["col_name"]: r["data_type"] for r in spark.sql("describe extended mart.dataset").collect()}
    assert described["Num Buckets"] == "32" and described["Bucket Columns"] == "[`laureate_id`]"
    assert [r["partition"].split("/")[0] for r in spark.sql("show partitions mart.countries").collect()] == [
        "upd_date=2022-12-19", "upd_date=2022-12-26",
    ]


def test_batch_of_new_prizes_is_only_added(spark, loaded, tmp_path):
    """Runs last: it loads a fourth batch."""
    w = loaded["w"]
    before = w.tables.known("dataset")["parts"]
    new = domain.person(30, 2005, "Physics", "Late Person", "1970-01-01", "Rome", "Italy", ("D Institute", "Munich", "Germany"))
    again = domain.person(8, 2006, "Peace", "Two Prizes", "1867-11-07", "Paris", "France", sex="Female")
    path = domain.write_csv(f"{tmp_path}/late", domain.LAUREATE_HEADER, [new, again])
    staging.land_laureates(spark, path, "stg.laureates", datetime.date(2023, 1, 9))
    w = warehouse.run(spark, "stg", "dwh", datetime.date(2023, 1, 9))
    after = w.tables.known("dataset")["parts"]
    assert {d: after[d] for d in before} == before and set(after) - set(before) == {"2023-01-09"}
    # Of the first commit's versions none is left, of the others all are.
    assert len(sinks.versions(spark, "dwh.organizations")) == 2
    assert w["dataset"].count() == 24
    assert one(w["dataset"], "organization_name1", "birth_city_region", where="laureate_id = 30") == ("D Institute", "07")
    assert rows(w["dataset"], "year", where="laureate_id = 8") == [(1903,), (1911,), (2006,)]
    findings = {name: rows(df, *df.columns) for name, df in warehouse.audit(w).items()}
    assert {name: found for name, found in findings.items() if found} == {}
