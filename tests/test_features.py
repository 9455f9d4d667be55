"""Entity aggregates of the alarm feed."""

from lanewatch.operators import features as FT

SCHEMA = "_rid long, ROTTA string, ZONA int, PAESE_PART string, TOT double, MOTIVO_ALLARME string, OCCORRENZE string"


def feed(spark):
    return spark.createDataFrame([
        (1, "A", None, "x", 2.0, "SDI", "Allarmi Chiusi"), (2, "A", 3, None, 5.0, "SDI", "Allarmi Chiusi"),
        (3, "A", 1, "a", None, None, None), (4, "A", 1, "x", 1.0, "NSIS", "Voli con Allarmi"),
        (5, "B", None, None, None, None, None), (6, None, 1, "x", 9.0, "SDI", "Allarmi Chiusi")], SCHEMA)


def test_alarm_aggregate_takes_the_first_known_zone_and_country(spark):
    got = {r["ROTTA"]: r for r in FT.alarm_entity_aggregate(feed(spark)).collect()}
    a, b = got["A"], got["B"]
    assert len(got) == 2
    assert (a["ZONA"], a["PAESE_PART"], a["n_osservazioni_allarmi"], a["tot_allarmi_sum"]) == (3, "x", 3, 8.0)
    assert (a["allarmi_chiusi"], a["voli_con_allarmi"], a["pct_sdi"], a["pct_nsis"]) == (7.0, 1.0, 2 / 3, 1 / 3)
    assert (b["ZONA"], b["PAESE_PART"], b["n_osservazioni_allarmi"], b["tot_allarmi_sum"], b["pct_sdi"]) == (None, None, 0, 0.0, 0.0)


def test_alarm_rows_are_not_sorted_for_their_aggregate(spark):
    """Only the sums by zone and country meet a sorting aggregation, not the rows."""
    plan = FT.alarm_entity_aggregate(feed(spark))._jdf.queryExecution().sparkPlan().toString()
    lowest = [line for line in plan.splitlines() if "Aggregate(" in line][-1]
    assert "HashAggregate(" in lowest and "Object" not in lowest and "ZONA" in lowest


TRAVELLERS = ("_rid long, ROTTA string, ENTRATI double, ALLARMATI double, INVESTIGATI double, tasso_allarme double, "
              "tasso_investigati double, GENERE string, FASCIA_ETA string, TIPO_DOCUMENTO string, NAZIONALITA string, "
              "COMPAGNIA_AEREA string, PAESE_PART string, ZONA int, ESITO_CONTROLLO string")


def travellers(spark):
    return spark.createDataFrame([
        (1, "A", 4.0, 1.0, 2.0, 0.25, 0.5, "M", "b", None, "ITA", "z", "x", 10, "RESPINTO"),
        (2, "A", 2.0, 1.0, 0.0, 0.5, 0.0, "F", "a", None, "ITA", "z", "x", 9, "FERMATO"),
        (3, "A", None, None, None, None, None, "F", "a", None, "FRA", "y", None, 10, "OK"),
        (4, "A", 1.0, 0.0, 0.0, 0.0, 0.0, None, "b", None, "FRA", "y", None, 9, None),
        (4, "A", 1.0, 0.0, 0.0, 0.0, 0.0, None, None, None, None, "z", None, None, None),
        (5, "B", None, None, None, None, None, None, None, None, None, None, None, None, None),
        (6, None, 9.0, 9.0, 9.0, 1.0, 1.0, "M", "c", "d", "ITA", "z", "x", 1, "OK")], TRAVELLERS)


def test_traveller_aggregate_takes_the_least_of_the_most_frequent_values(spark):
    got = {r["ROTTA"]: r for r in FT.traveller_entity_aggregate(travellers(spark)).collect()}
    a, b = got["A"], got["B"]
    assert len(got) == 2
    modes = [*FT.FEW_VALUED.values(), *FT.MANY_VALUED.values()]
    assert [a[c] for c in modes] == ["F", "a", "ND", "x", 9, "FRA", "z"]
    assert (a["tot_entrati"], a["tot_allarmati"], a["tot_investigati"], a["n_osservazioni_viag"]) == (8.0, 2.0, 2.0, 4)
    assert (a["tasso_allarme_medio"], a["n_respinti"], a["n_fermati"], a["tasso_respinti"]) == (0.1875, 1, 1, 0.25)
    assert [b[c] for c in modes] == ["ND", "ND", "ND", None, None, "ND", "ND"]
    assert (b["tot_entrati"], b["n_osservazioni_viag"], b["tasso_allarme_medio"], b["tasso_respinti"]) == (0.0, 0, None, 0.0)


def test_traveller_aggregate_inside_groups(spark):
    both = travellers(spark).selectExpr("*", "explode(if(_rid < 3, array(0, 1), array(1))) AS p")
    got = {(r["p"], r["ROTTA"]): r for r in FT.traveller_entity_aggregate(both, by=("p",)).collect()}
    assert set(got) == {(0, "A"), (1, "A"), (1, "B")}
    assert (got[0, "A"]["genere_predominante"], got[0, "A"]["_zona_fallback"], got[0, "A"]["tot_entrati"]) == ("F", 9, 6.0)


def test_traveller_rows_are_not_sorted_for_their_aggregate(spark, monkeypatch):
    """Only the counts by value meet a sorting aggregation, not the rows."""
    plans = []
    monkeypatch.setattr(FT, "keep", lambda df: plans.append(df) or df)
    FT.traveller_entity_aggregate(travellers(spark), by=("_rid",))
    plan = plans[0]._jdf.queryExecution().sparkPlan().toString()
    lowest = [line for line in plan.splitlines() if "Aggregate(" in line][-1]
    assert "HashAggregate(" in lowest and "Object" not in lowest and "COMPAGNIA_AEREA" in lowest


def test_merge_matches_no_null_key_and_parses_every_date_once(spark):
    alarms = spark.createDataFrame([(1, "F", "R", "2020-01-02 05:00:00"), (2, "F", "R", None), (3, None, "R", "2020-01-02 00:00:00"),
                                    (4, "F", "R", "2020-01-09 00:00:00")], "_rid long, AREOPORTO_ARRIVO string, AREOPORTO_PARTENZA string, s string") \
        .selectExpr("_rid", "AREOPORTO_ARRIVO", "AREOPORTO_PARTENZA", "cast(s AS timestamp) AS DATA_PARTENZA")
    travellers = spark.range(6).selectExpr(
        "if(id = 5, null, 'F') AS AREOPORTO_ARRIVO", "'R' AS AREOPORTO_PARTENZA",
        "try_to_timestamp(if(id < 3, '2020-01-02', 'none'), 'y-M-d') AS DATA_PARTENZA", "double(id + 1) AS ENTRATI", "0D AS ALLARMATI",
        "0D AS INVESTIGATI", "0.5D AS tasso_allarme", "0D AS tasso_investigati", "string(id % 2) AS NAZIONALITA", "'FERMATO' AS ESITO_CONTROLLO")
    merged = FT.merge_feeds(alarms, travellers)
    got = {r["_rid"]: (r["tot_entrati"], r["n_nazionalita"], r["n_fermati"]) for r in merged.collect()}
    assert got == {1: (6.0, 2, 3), 2: (None,) * 3, 3: (None,) * 3, 4: (None,) * 3}
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("y-M-d") == 1, plan
