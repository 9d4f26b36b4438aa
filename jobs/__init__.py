"""Runnable jobs: each module has ``run(session, paths, settings)`` and a command line that makes the session."""
