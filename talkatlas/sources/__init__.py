"""Readers and writers for the tables that the stages exchange."""
