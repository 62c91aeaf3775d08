"""Configuration, whole analyses and registered queries."""
