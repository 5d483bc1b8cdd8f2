"""Readers. All paths may be any URI the session's file systems know."""
