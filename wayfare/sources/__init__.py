"""Readers for the relational, document and event sources, and the tables written."""
