"""Runs that combine several reports."""
