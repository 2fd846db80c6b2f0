"""Small inputs with known outcomes."""

import json
import os

# Invented readings: type, route, clock time on 2022-11-08 in India, speed, fuel. The third block is late: its first reading
# is in a minute that a delay of one minute still lets in after the second block, its second reading is not.
TRAFFIC_BLOCKS = [
    [
        ("Tram", "N1", "08:10:04", 31, 50),
        ("Van", "E5", "08:10:09", 52, 41),
        ("Scooter", "N1", "08:10:12", 18, 7),
        ("Tram", "N1", "08:10:29", 27, 48),
        ("Van", "E5", "08:10:31", 64, 40),
        ("Coach", "E5", "08:10:44", 77, 90),
        ("Tanker", "N2", "08:10:58", 45, 120),
    ],
    [
        ("Tram", "N1", "08:12:00", 35, 49),
        ("Coach", "N2", "08:12:14", 71, 88),
        ("Scooter", "N1", "08:12:22", 22, 6),
        ("Coach", "E5", "08:12:35", 69, 87),
        ("Tanker", "N2", "08:12:40", 41, 118),
    ],
    [
        ("Tram", "N2", "08:11:00", 30, 47),
        ("Van", "N1", "08:10:59", 58, 39),
    ],
]


def traffic_line(vehicle, reading):
    kind, route, clock, speed, fuel = reading
    return json.dumps(
        {
            "vehicleId": vehicle,
            "vehicleType": kind,
            "routeId": route,
            "latitude": "48.2",
            "longitude": "16.4",
            "time": f"Tue Nov 08 {clock} IST 2022",
            "speed": float(speed),
            "fuelLevel": float(fuel),
        }
    )


def traffic_blocks(blocks=TRAFFIC_BLOCKS):
    return [[traffic_line(f"v{b}-{i}", r) for i, r in enumerate(block)] for b, block in enumerate(blocks)]


# Invented events: user, clock time on 2021-06-30 two hours east of Greenwich, is it the last event. Each user has two
# events less than half a minute apart, and a last one more than half a minute later.
USER_EVENTS = [
    (21, "09:15:02", False),
    (22, "09:15:06", False),
    (23, "09:15:07", False),
    (24, "09:15:12", False),
    (22, "09:15:20", False),
    (21, "09:15:24", False),
    (24, "09:15:30", False),
    (23, "09:15:33", False),
    (23, "09:16:20", True),
    (21, "09:16:22", True),
    (22, "09:16:27", True),
    (24, "09:16:31", True),
]


def user_line(event):
    user, clock, last = event
    return f"{user} 2021-06-30T{clock}.000+02:00 /shop/{user} {str(last).lower()}"


def write_blocks(folder, blocks):
    """One file per block, their times telling their order."""
    os.makedirs(folder, exist_ok=True)
    for i, block in enumerate(blocks):
        path = os.path.join(folder, f"block{i:03}.txt")
        with open(path, "w") as f:
            f.writelines(line + "\n" for line in block)
        os.utime(path, (1_600_000_000 + i, 1_600_000_000 + i))
    return str(folder)
