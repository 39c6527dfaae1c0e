"""Every reporter of the reference is found in a running text."""

from pyspark.sql import functions as F

from docketry.functions import extract

EXAMPLES = {
    "air": "AIR 1973 SC 1461",
    "scc_parenthetical": "(1973) 4 SCC 225",
    "scc_standard": "2024 SCC 5 123",
    "scc_online": "2024 SCC OnLine SC 77",
    "scc_online_hc": "2024 SCC OnLine Del 1234",
    "scr_standard": "SCR (1) 2024 45",
    "scr_bracket": "[1990] 2 SCR 12",
    "manu": "MANU/TN/2010/1707",
    "neutral_sc": "2023 INSC 4",
    "neutral_hc_colon": "2024:AHC-LKO:12762-DB",
    "neutral_hc_slash": "2024/DHC/1234",
    "scale": "(2024) 5 SCALE 123",
    "jt": "JT 2024 (5) SC 123",
    "bom_lr": "2001 (3) Bom LR 9",
    "dlt": "2002 (4) DLT 8",
    "guj_lr": "2003 Guj LR 7",
    "klj": "2004 (5) KLJ 6",
    "klt": "2005 (6) KLT 5",
    "mlw": "2006 (7) MLW 4",
    "alj": "2007 ALJ 3",
    "plr": "PLR 2008 2",
    "cwn": "2009 (8) CWN 1",
    "itat": "ITA No. 512/Del/2019",
    "nclt": "NCLT Order dated 01.02.2020 in CP No. 45",
    "ilr": "ILR 2024 Kar 5 123",
    "cri_lj": "(1998) 2 Cri LJ 4021",
    "comp_cas": "(1999) 95 Comp Cas 12",
    "itr": "(2000) 243 ITR 83",
    "taxman": "(2001) 115 Taxman 6",
    "gst": "2018 GST 44",
}
OTHER_FORMS = [("neutral_hc_colon", "2024:KER:5678"), ("itat", "2020 ITAT 31"), ("nclt", "NCLAT 12"), ("cri_lj", "1998 Cri LJ 4021")]


def test_all_reporters(spark):
    assert len(EXAMPLES) == 30 and set(extract.REPORTERS) == set(EXAMPLES)
    want = [*EXAMPLES.items(), *OTHER_FORMS]
    text = "; see ".join(raw for _, raw in want)
    found = spark.createDataFrame([(text,)], "t string").select(F.explode(extract.citations(F.col("t"))).alias("c")).select("c.*").collect()
    assert sorted((r.reporter, r.raw) for r in found) == sorted(want)
