"""The alias table that the queries of problem 6 give to map_values(): words written short, and phrases that mean a part of an entry in other
words. Another list needs a table of its own; the operator has none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Words written short. Fixed values.
SHORT = {
    "qtrly": "quarterly", "mgmt": "management", "mgt": "management", "perf": "performance", "cust": "customer", "docs": "documentation", "doc": "documentation", "eng": "engineering", "db": "database", "k8s": "kubernetes", "js": "javascript",
    "apps": "applications", "app": "application", "reorg": "reorganisation", "asst": "assistant", "autom": "automation", "gov": "governance", "comms": "communication", "resp": "response", "eval": "evaluation", "evals": "evaluation", "sec": "security",
    "analytix": "analytics", "config": "configuration", "infra": "infrastructure", "dev": "developer", "org": "organisation", "biz": "business", "comp": "comparison", "cmp": "comparison", "diff": "differences", "diffs": "differences", "exec": "executive",
    "acq": "acquisition", "cert": "certificate", "certs": "certificate", "creds": "credential", "cred": "credential", "pwd": "password", "pw": "password", "repl": "replication", "reqs": "requirements", "req": "requirement", "prep": "preparation", "int": "integration",
    "lang": "language", "ref": "reference", "refs": "references", "spec": "specification", "stats": "statistics", "std": "standard", "stds": "standards", "temp": "template", "mtg": "meeting", "mgr": "manager", "mngr": "manager", "ppl": "people", "proj": "project", "prod": "product", "qual": "quality",
    "reg": "regional", "sched": "scheduling", "svc": "service", "synth": "synthetic", "tx": "transaction", "vuln": "vulnerability", "wh": "warehouse", "xfer": "transfer", "ops": "operations", "postgresql": "postgres", "pg": "postgres", "sso": "federation", "recs": "records", "rec": "records", "pct": "percent",
}
#: Phrases that mean an aspect or a subject in other words. Fixed values; more can be given.
PHRASES = {
    "why it fails": "failure analysis", "why they fail": "failure analysis", "what goes wrong": "failure analysis", "what we learned": "lessons learned", "what we have learned": "lessons learned", "what i learned": "lessons learned", "typical mistakes": "common mistakes", "frequent mistakes": "common mistakes", "mistakes people make": "common mistakes",
    "tool vs": "tool comparison", "tools vs": "tool comparison", "vendor vs": "vendor comparison", "vendors vs": "vendor comparison", "differences by region": "regional differences", "standard names": "naming standards", "standards for names": "naming standards", "a manager s view": "manager perspective", "manager s view": "manager perspective", "the manager s view": "manager perspective", "view of a manager": "manager perspective",
    "1 1s": "one on ones", "1 on 1s": "one on ones", "1on1s": "one on ones", "1s": "one on ones", "a b test analysis": "experiment analysis", "ab test analysis": "experiment analysis", "a b testing": "experiment analysis", "re org": "reorganisation", "re organisation": "reorganisation", "re organization": "reorganisation", "plan for migrating": "migration plan", "planning the migration": "migration plan", "long run effects": "long term effects",
    "cutting cost": "cost control", "keeping cost down": "cost control", "effects over time": "long term effects", "who owns it": "ownership model", "how to measure": "measurement approach", "debate about the roadmap": "roadmap debate", "what it costs per unit": "unit economics", "reporting to the board": "board reporting", "security fixes": "security response", "wfh": "remote",
}


def alias_table(spark: SparkSession) -> DataFrame:
    """alias, meaning, kind (word or phrase)."""
    return spark.createDataFrame([*((a, m, "word") for a, m in SHORT.items()), *((a, m, "phrase") for a, m in PHRASES.items())], "alias string, meaning string, kind string")
