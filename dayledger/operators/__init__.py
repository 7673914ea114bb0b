"""DataFrame operators: pairing, series, prefixes, unions, arrivals, reports."""
