"""DataFrame-to-DataFrame transforms; every one is lazy unless it says otherwise."""
