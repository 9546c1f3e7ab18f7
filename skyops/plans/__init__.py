"""Marts, reports, audits and the runs that tie everything together."""
