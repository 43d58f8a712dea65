"""Readers and the labelled views the jobs run on."""
