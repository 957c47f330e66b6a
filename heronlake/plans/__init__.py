"""Registered jobs, one module per family."""

from heronlake.plans import logs, ml, reco, relational, streams, text, vectors  # noqa: F401
