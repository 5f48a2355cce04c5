"""Corpus analytics on Spark: provenance, labels, rankings, ledgers and audits as DataFrame operators."""
