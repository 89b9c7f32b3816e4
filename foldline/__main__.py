"""``python -m foldline``: the end-to-end run from the command line."""

from foldline.plans.runner import main

if __name__ == "__main__":
    main()
