"""Alarm and traveller feeds derived from the star-schema tables.

The two feeds of the risk pipeline are expressed over lineitem / orders /
customer / supplier / nation so that every stage runs on data whose size grows
with the scale factor.  Mapping (canonical column <- proxy expression):

  route ROTTA              upper(supplier nation) || '-' || upper(customer nation)
  PAESE_PART / ZONA        supplier nation name / its region key
  DATA_PARTENZA            l_shipdate
  alarm feed               line items with l_returnflag = 'R'
    TOT                    l_quantity
    MOTIVO_ALLARME         o_orderpriority (MOTIVE_OF_PRIORITY)
    OCCORRENZE             o_orderstatus || l_linestatus (OCCURRENCE_OF_STATUS)
  traveller feed           line items with l_returnflag <> 'R'
    ENTRATI                l_quantity
    INVESTIGATI/ALLARMATI  floor(q*discount*10) / floor(q*tax*5)
    ESITO_CONTROLLO        l_linenumber (OUTCOME_OF_LINENUMBER, else OK)
    GENERE, FASCIA_ETA, TIPO_DOCUMENTO, NAZIONALITA, COMPAGNIA_AEREA
                           l_linestatus, o_orderpriority, c_mktsegment,
                           customer nation name, s_name
  _rid                     l_orderkey * 16 + l_linenumber (stable "file order")

``grain='supplier'`` keys routes on (supplier, customer nation) instead of
(nation, nation): many more entities, used to stress the detectors.

All joins are plain equi-joins without hints: Spark broadcasts only under its size
threshold (autoBroadcastJoinThreshold / AQE), so orders, customer and supplier —
which grow with the data — are shuffled at scale while nation is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewatch.functions.columns import lookup, safe_div
from lanewatch.sources.tables import table

# ---------------------------------------------------------------- FIXED VALUES
MOTIVE_OF_PRIORITY = {
    "1-URGENT": "INTERPOL",
    "2-HIGH": "SDI",
    "3-MEDIUM": "NSIS",
    "4-NOT SPECIFIED": "TSC",
    "5-LOW": "Manuale",
}
OCCURRENCE_OF_STATUS = {
    "OO": "Allarmi Chiusi",
    "OF": "Allarmi NON Chiusi",
    "PO": "Allarmi Rilevanti",
    "PF": "Voli con Allarmi",
    "FO": "Nulla a procedere SDI",
    "FF": "Allarmi generati da SDI/NSIS",
}
OUTCOME_OF_LINENUMBER = {2: "RESPINTO", 3: "FERMATO", 4: "SEGNALATO", 5: "IN ATTESA"}
# ------------------------------------------------------------ END FIXED VALUES


def _base(spark: SparkSession, sf_dir: str, alarms: bool, grain: str = "nation") -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    li = li.filter(F.col("l_returnflag") == "R") if alarms else li.filter(F.col("l_returnflag") != "R")
    li = li.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_discount",
                   "l_tax", "l_linestatus", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                   "o_orderpriority")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_name")
    nation = table(spark, sf_dir, "nation")
    ns = nation.select(F.col("n_nationkey").alias("ns_key"), F.col("n_name").alias("ns_name"),
                       F.col("n_regionkey").alias("ns_region"))
    nc = nation.select(F.col("n_nationkey").alias("nc_key"), F.col("n_name").alias("nc_name"))
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
           .join(cust, F.col("o_custkey") == F.col("c_custkey"))
           .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
           .join(ns, F.col("s_nationkey") == F.col("ns_key"))
           .join(nc, F.col("c_nationkey") == F.col("nc_key")))
    dep = F.upper(F.col("s_name")) if grain == "supplier" else F.upper(F.col("ns_name"))
    arr = F.upper(F.col("nc_name"))
    ts = F.col("l_shipdate")
    return j.select(
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("_rid"),
        dep.alias("AREOPORTO_PARTENZA"),
        arr.alias("AREOPORTO_ARRIVO"),
        F.concat(dep, F.lit("-"), arr).alias("ROTTA"),
        F.col("ns_name").alias("PAESE_PART"),
        F.col("nc_name").alias("PAESE_ARR"),
        F.col("ns_region").cast("int").alias("ZONA"),
        ts.alias("DATA_PARTENZA"),
        F.year(ts).alias("ANNO_PARTENZA"),
        F.month(ts).alias("MESE_PARTENZA"),
        F.hour(ts).alias("ora_partenza"),
        F.weekday(ts).alias("giorno_settimana"),
        F.month(ts).alias("mese"),
        "l_quantity", "l_discount", "l_tax", "l_linenumber", "l_linestatus",
        "o_orderstatus", "o_orderpriority", "c_mktsegment", "s_name", "nc_name",
    )


def alarm_feed(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    b = _base(spark, sf_dir, alarms=True, grain=grain)
    return b.select(
        "_rid", "AREOPORTO_PARTENZA", "AREOPORTO_ARRIVO", "ROTTA", "PAESE_PART", "PAESE_ARR",
        "ZONA", "DATA_PARTENZA", "ANNO_PARTENZA", "MESE_PARTENZA",
        F.col("l_quantity").alias("TOT"),
        lookup(MOTIVE_OF_PRIORITY, F.col("o_orderpriority")).alias("MOTIVO_ALLARME"),
        lookup(OCCURRENCE_OF_STATUS, F.concat("o_orderstatus", "l_linestatus")).alias("OCCORRENZE"),
        "ora_partenza", "giorno_settimana", "mese",
    )


def traveller_feed(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    b = _base(spark, sf_dir, alarms=False, grain=grain)
    entrati = F.col("l_quantity")
    inv = F.floor(F.col("l_quantity") * F.col("l_discount") * 10).cast("double")
    allr = F.floor(F.col("l_quantity") * F.col("l_tax") * 5).cast("double")
    outcome = F.coalesce(lookup(OUTCOME_OF_LINENUMBER, F.col("l_linenumber")), F.lit("OK"))
    return b.select(
        "_rid", "AREOPORTO_PARTENZA", "AREOPORTO_ARRIVO", "ROTTA", "PAESE_PART", "PAESE_ARR",
        "ZONA", "DATA_PARTENZA", "ANNO_PARTENZA", "MESE_PARTENZA",
        entrati.alias("ENTRATI"), inv.alias("INVESTIGATI"), allr.alias("ALLARMATI"),
        outcome.alias("ESITO_CONTROLLO"),
        F.col("l_linestatus").alias("GENERE"),
        F.col("o_orderpriority").alias("FASCIA_ETA"),
        F.col("c_mktsegment").alias("TIPO_DOCUMENTO"),
        F.col("nc_name").alias("NAZIONALITA"),
        F.col("s_name").alias("COMPAGNIA_AEREA"),
        safe_div(allr, entrati).alias("tasso_allarme"),
        safe_div(inv, entrati).alias("tasso_investigati"),
        "ora_partenza", "giorno_settimana", "mese",
    )


def raw_alarm_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string 'dirty' alarm records derived by expression from clean columns.

    Exercises the cleaning operators (null tokens, Italian months, mixed date
    formats, noisy numbers, ISO2 codes, padded airport codes) on data that
    grows with the tables.
    """
    b = _base(spark, sf_dir, alarms=True)
    ln = F.col("l_linenumber")
    ts = F.col("DATA_PARTENZA")
    q = F.col("l_quantity").cast("int").cast("string")
    date_s = (F.when(ln == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
               .when(ln == 2, F.date_format(ts, "yyyy/MM/dd"))
               .when(ln == 3, F.date_format(ts, "dd.MM.yyyy"))
               .when(ln == 4, F.date_format(ts, "dd-MM-yy"))
               .when(ln == 5, F.concat(F.upper(F.date_format(ts, "MMM")), F.lit(" "),
                                       F.date_format(ts, "d yyyy")))
               .when(ln == 6, F.lit("garbage"))
               .otherwise(F.date_format(ts, "yyyy-MM-dd")))
    tot_s = (F.when(ln == 1, F.concat(q, F.lit(" pax")))
              .when(ln == 2, F.concat(F.lit("~"), q))
              .when(ln == 3, F.lit("N.D."))
              .when(ln == 4, F.lit("-5"))
              .when(ln == 5, F.lit("1,5"))
              .when(ln == 6, F.concat(q, F.lit(" voli")))
              .otherwise(q))
    zone_s = F.when(ln == 7, F.lit("?")).otherwise(F.col("ZONA").cast("string"))
    return b.select(
        "_rid",
        F.concat(F.lit(" "), F.lower(F.col("nc_name")), F.lit(" ")).alias("AREOPORTO_ARRIVO"),
        F.lower(F.col("AREOPORTO_PARTENZA")).alias("AREOPORTO_PARTENZA"),
        F.when(ln.isin(3, 6), F.lit("24")).otherwise(F.col("ANNO_PARTENZA").cast("string")).alias("ANNO_PARTENZA"),
        F.when(ln.isin(2, 6), F.lit("GEN")).otherwise(F.col("MESE_PARTENZA").cast("string")).alias("MESE_PARTENZA"),
        date_s.alias("DATA_PARTENZA"),
        tot_s.alias("TOT"),
        zone_s.alias("ZONA"),
        F.when(ln == 7, F.lit("N/C")).otherwise(
            lookup(OCCURRENCE_OF_STATUS, F.concat("o_orderstatus", "l_linestatus"))).alias("OCCORRENZE"),
        F.when(ln % 2 == 0, F.lit("it")).otherwise(F.lit("DE")).alias("CODICE_PAESE_ARR"),
        F.when(ln == 5, F.lit("ZZ")).otherwise(F.lit("AL")).alias("CODICE_PAESE_PART"),
        F.concat(F.lit(" "), F.col("PAESE_ARR")).alias("PAESE_ARR"),
        F.concat(F.col("PAESE_PART"), F.lit(" ")).alias("PAESE_PART"),
        F.concat(F.lit(" "), lookup(MOTIVE_OF_PRIORITY, F.col("o_orderpriority"))).alias("MOTIVO_ALLARME"),
    )


def raw_traveller_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string 'dirty' traveller records derived by expression."""
    b = _base(spark, sf_dir, alarms=False)
    ln = F.col("l_linenumber")
    ts = F.col("DATA_PARTENZA")
    q = F.col("l_quantity").cast("int").cast("string")
    inv = F.floor(F.col("l_quantity") * F.col("l_discount") * 10).cast("int").cast("string")
    allr = F.floor(F.col("l_quantity") * F.col("l_tax") * 5).cast("int").cast("string")
    return b.select(
        "_rid",
        F.col("AREOPORTO_ARRIVO"),
        F.concat(F.col("AREOPORTO_PARTENZA"), F.lit(" ")).alias("AREOPORTO_PARTENZA"),
        F.col("ANNO_PARTENZA").cast("string").alias("ANNO_PARTENZA"),
        F.col("MESE_PARTENZA").cast("string").alias("MESE_PARTENZA"),
        F.when(ln <= 3, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
         .otherwise(F.date_format(ts, "d/M/yyyy")).alias("DATA_PARTENZA"),
        F.when(ln == 1, F.concat(q, F.lit(" pax"))).otherwise(q).alias("ENTRATI"),
        F.when(ln == 6, F.concat(F.lit("~"), F.lit("99"))).otherwise(inv).alias("INVESTIGATI"),
        F.when(ln == 5, F.lit("-1")).otherwise(allr).alias("ALLARMATI"),
        F.when(F.col("l_linestatus") == "O", F.lit("Maschio"))
         .when(ln == 7, F.lit("1")).otherwise(F.lit("f.")).alias("GENERE"),
        F.when(ln == 2, F.lit("Visto")).when(ln == 3, F.lit("Passaporto"))
         .otherwise(F.col("c_mktsegment")).alias("TIPO_DOCUMENTO"),
        F.when(ln == 1, F.lit("minore")).when(ln == 2, F.lit("18-30")).when(ln == 3, F.lit("61+"))
         .when(ln == 4, F.lit("-5")).otherwise(F.col("o_orderpriority")).alias("FASCIA_ETA"),
        F.when(ln % 3 == 0, F.lit("it")).when(ln % 3 == 1, F.lit(" TR "))
         .otherwise(F.col("nc_name")).alias("NAZIONALITA"),
        F.coalesce(lookup(OUTCOME_OF_LINENUMBER, ln), F.lit("OK")).alias("ESITO_CONTROLLO"),
        F.col("s_name").alias("COMPAGNIA_AEREA"),
        F.col("ZONA").cast("string").alias("ZONA"),
        F.concat(F.col("PAESE_PART"), F.lit(" ")).alias("PAESE_PART"),
    )
