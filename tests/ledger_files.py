"""Lines and files of the four fixed-width records, for tests."""


def customer_line(key=1, first="Ola", last="Berg"):
    return f"{key:>19}{first:<10}{last:<10}{'7 Quarry Lane':<20}{'Halden':<10}{'OF':<2}{'1771':<7}{'Norway':<10}"


def account_line(key, start="2026-01-01", end="", kind="CHECKING"):
    return f"{key:>19}{start:<10}{end:<10}{kind:<8}"


def relationship_line(account, customer, kind="PRIMARY"):
    return f"{account:>19}{customer:>19}{kind:<9}"


def transaction_line(key, account, kind, amount):
    return f"{key:>19}{account:>19}{kind:<6}{amount:>20}"


def write_files(folder, compact, customer=(), account=(), relationship=(), transaction=()):
    folder.mkdir(parents=True, exist_ok=True)
    records = {"customer": customer, "account": account, "relationship": relationship, "transaction": transaction}
    for record, lines in records.items():
        (folder / f"{record}_{compact}.dat").write_text("".join(f"{line}\n" for line in lines), encoding="utf-8")
    return str(folder)
