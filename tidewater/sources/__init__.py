"""Readers: bronze tables, landing files, web pages, streams and the sample star schema."""
