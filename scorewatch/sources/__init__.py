"""Readers, writers and the derivation of monitored tables from the test tables."""
