"""Sources and sinks: driver tables, rendered invoices, file manifests, envelopes, sinks."""
