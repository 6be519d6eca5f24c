"""Labelled pages that the extraction weights are fitted on.

The main text of each page stands between ``<!--main-->`` and ``<!--/main-->``.
"""

LABELLED = (
    "<html><head><title>Tide tables</title><style>p{color:red}</style></head><body><header><a href='/'>Harbour news</a></header>"
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>Boats</a></li></ul></nav><article><!--main--><h1>Tide tables for the bay</h1>"
    "<p>The tide rises twice a day and the boats leave the <b>inner harbour</b> with it.</p><p>Ask the office for a printed table before you sail.</p>"
    "<!--/main--></article><aside><p>Most read this week</p></aside><footer><p>All rights reserved by the harbour office</p></footer></body></html>",
    "<html><body><div class='menu'><a href='1'>Start</a> <a href='2'>Recipes</a></div><div class='ad'>Buy two pans and get a lid for free today</div>"
    "<div class='content'><!--main--><h2>Barley soup</h2><p>Wash the barley, cover it with water and leave it to stand for an hour.</p>"
    "<ul><li>two carrots</li><li>one leek</li></ul><p>Boil everything <a href='x'>slowly</a> until it is soft.</p><!--/main--></div>"
    "<div class='comments'><p>Lovely, I made it with rice instead of barley.</p><form><label>Your name</label><button>Send</button></form></div>"
    "<div id='footer'>Contact and imprint</div></body></html>",
    "<html><body><main><!--main--><h1>Notes on grafting</h1><p>Cut the branch at an angle while the tree is at rest.</p><blockquote>Bind it firmly,"
    " said the old gardener.</blockquote><table><tr><td>apple</td><td>March</td></tr></table><!--/main--></main>"
    "<section class='related'><h3>Read on</h3><a href='y'>Pruning pears</a></section><div class='cookie-notice'>We use cookies to measure visits</div>"
    "<footer>Garden club <a href='z'>Imprint</a></footer></body></html>",
    "<html><body><nav><a href='q'>News</a> <a href='r'>Sport</a> <a href='s'>Weather</a></nav><article><!--main--><h1>Bridge opens</h1><p>The new bridge"
    " opened on Monday after two years of work.<br>Traffic was light all morning.</p><p>The old one stays for walkers.</p><!--/main--></article>"
    "<p>Published by the harbour desk</p><div class='share'>Share this page with friends</div><div class='sidebar'><p>Subscribe to the weekly letter</p></div></body></html>",
    "<html><body><div class='x1'><a href='1'>Startseite</a><a href='2'>Nachrichten</a><a href='3'>Wetter</a></div><div class='kopfzeile'>Hafenblatt am Morgen</div>"
    "<div class='x2'><!--main--><h1>Neue Fähre</h1><p>Die neue Fähre fährt seit Montag viermal am Tag zur Insel.</p><p>Karten gibt es am Kai, und wer mag,"
    " kauft sie <a href='k'>im Voraus</a>.</p><ul><li>Hin und zurück</li><li>Kinder frei</li></ul><p>Im Winter fährt sie seltener, sagt der Hafenmeister.</p><!--/main--></div>"
    "<div class='x3'><a href='4'>Kontakt</a> <a href='5'>Impressum</a> <a href='6'>Datenschutz</a></div><div>Stand: Mai</div></body></html>",
    "<html><body><table><tr><td><a href='a'>Home</a></td><td><a href='b'>News</a></td><td><a href='c'>Sport</a></td></tr></table><ul><li>Home</li><li>News</li><li>Sport</li></ul>"
    "<div><!--main--><p>The committee met on Thursday and heard three reports about the canal.</p><h2>Costs</h2><p>The first report puts the costs far above the plan.</p>"
    "<p>The members asked for another one before the summer, and went home early.</p><!--/main--></div><p>Next page</p><p>Top stories</p><p><a href='d'>A dog swam to the island</a></p>"
    "<p><a href='e'>Council cuts the grass</a></p><div>Terms Privacy Imprint</div></body></html>",
)
