"""Readers and writers: the CSV feed, the table store, driver-table fixtures."""
