"""Sources and sinks: delimited and XML loads with provenance, lookups, release-partitioned
writes, table replace loads, fan-out, and page/text extraction over tables of pages."""
