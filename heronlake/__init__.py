"""Analytics jobs on tables and streams, written as DataFrame -> DataFrame functions."""
