"""Readers and writers: ratings TSV, catalogue CSV, JSON reports, test-table view."""
