"""Pages written by hand, each in a layout of its own, with the text that belongs to the article.

They share no template with the generator of the training pages: what is text and what is not is said here
by the pages themselves.
"""

PAGES = [
    # A newspaper with tables for the layout, as pages were made around the year 2000.
    (
        """<html><body bgcolor=white><table width=100%><tr><td colspan=2><a href=/><img src=logo.gif></a> <a href=/world>World</a> | <a href=/sport>Sport</a> | <a href=/arts>Arts</a></td></tr>
<tr><td valign=top width=120><a href=/a>Weather</a><br><a href=/b>Letters</a><br><a href=/c>Archive</a></td>
<td><h1>Bridge reopens after eleven years</h1><p>The old bridge over the river was opened to walkers on Monday, eleven years after the flood took its middle arch.</p>
<p>"We had nearly given up," said the mayor, who cut the ribbon. The work, she added, cost less than feared.</p><p>Cars will have to wait until spring.</p></td></tr>
<tr><td colspan=2><font size=1>Copyright 2001 The Valley Post. All rights reserved.</font></td></tr></table></body></html>""",
        "Bridge reopens after eleven years The old bridge over the river was opened to walkers on Monday, eleven years after the flood took its middle arch. \"We had nearly given up,\" said the mayor, who cut the ribbon. The work, she added, cost less than feared. Cars will have to wait until spring.",
    ),
    # A blog with its own class names and a long blogroll.
    (
        """<!doctype html><html><head><title>Bread | Kitchen notes</title></head><body class="home"><div id="wrap"><div id="hd"><h2><a href="/">Kitchen notes</a></h2></div>
<div id="bd"><div class="hentry"><h3 class="entry-title">Bread without kneading</h3><div class="entry-content"><p>Flour, water, salt and a little yeast are all you need, and time does the rest.</p>
<p>Mix everything in the evening. Leave the bowl, covered, on the table overnight.</p><ul><li>500 g of flour, sifted.</li><li>350 g of water, cold.</li></ul><p>In the morning, fold it once and bake it hot.</p></div></div></div>
<div class="sidebar"><h4>Blogroll</h4><ul><li><a href=/1>Salt and pepper</a></li><li><a href=/2>The green pan</a></li><li><a href=/3>Soup season</a></li></ul></div>
<div id="ft" class="footer"><p>Powered by patience.</p></div></div></body></html>""",
        "Bread without kneading Flour, water, salt and a little yeast are all you need, and time does the rest. Mix everything in the evening. Leave the bowl, covered, on the table overnight. 500 g of flour, sifted. 350 g of water, cold. In the morning, fold it once and bake it hot.",
    ),
    # Elements by their meaning, a consent dialog first, related stories inside main.
    (
        """<html lang=en><body><dialog open class="consent"><p>We use cookies, and so do our partners. Do you agree?</p><button>Yes</button></dialog><header><nav aria-label="Main menu"><a href=/>Start</a><a href=/x>Topics</a></nav></header>
<main><article><header><h1>Why owls are silent</h1><p>By a reader of feathers</p></header><p>The leading edge of an owl's wing carries a comb, which breaks the air into small streams.</p><p>Its upper side is soft as velvet, so that feathers do not rub.</p>
<figure><img src=owl.jpg><figcaption>A barn owl, at dusk.</figcaption></figure><p>Together, they make a flight that mice do not hear.</p></article>
<aside class="related"><h2>Related stories</h2><ul><li><a href=/1>How bats hear</a></li><li><a href=/2>Moths that listen</a></li></ul></aside></main><footer><p>Imprint, contact, and so on.</p></footer></body></html>""",
        "Why owls are silent By a reader of feathers The leading edge of an owl's wing carries a comb, which breaks the air into small streams. Its upper side is soft as velvet, so that feathers do not rub. A barn owl, at dusk. Together, they make a flight that mice do not hear.",
    ),
    # A forum-like page: the text, then what readers said.
    (
        """<html><body><div class="navbar"><a href=/>Home</a> <a href=/new>New</a> <a href=/ask>Ask</a></div><div class="post"><h1>My first winter on the island</h1><p>The ferry stopped in November, and with it the newspaper, the mail and the bread.</p><p>By January I knew all the birds, or thought so.</p></div>
<div id="comments"><h3>3 comments</h3><div class="comment"><b>Ann</b><p>Lovely, thank you, I could smell the sea.</p></div><div class="comment"><b>Bo</b><p>How did you keep warm, though?</p></div><div class="comment"><b>Cy</b><p>Same here, in the hills.</p></div></div></body></html>""",
        "My first winter on the island The ferry stopped in November, and with it the newspaper, the mail and the bread. By January I knew all the birds, or thought so.",
    ),
    # Documentation: a long menu of chapters at the left, code, definitions.
    (
        """<html><body><div role="navigation" class="toc"><ul><li><a href=#1>Install</a></li><li><a href=#2>First steps</a></li><li><a href=#3>Options</a></li><li><a href=#4>Errors</a></li><li><a href=#5>Changes</a></li></ul></div>
<section class="content"><h1>First steps</h1><p>Open a window, type the name of the tool, and press the key.</p><pre>tool --help</pre><p>It lists what it can do, in the order of use.</p><dl><dt>run</dt><dd>Does the work, quietly.</dd><dt>show</dt><dd>Tells what it would do.</dd></dl></section></body></html>""",
        "First steps Open a window, type the name of the tool, and press the key. tool --help It lists what it can do, in the order of use. run Does the work, quietly. show Tells what it would do.",
    ),
    # A shop's magazine: promotion blocks between the paragraphs.
    (
        """<html><body><header class="masthead"><a href=/>Outdoor</a><form action=/s><input name=q><button>Search</button></form></header><article class="story"><h1>Five huts worth the climb</h1><p>Some huts have soup, some have a view, and a few have both.</p>
<div class="promo"><p>Save 20 percent on boots, today only.</p></div><p>The first lies above the tree line, four hours from the road.</p><div class="advertisement">Buy two tents, get one free.</div><p>The last one has no door, which nobody minds in July.</p></article>
<footer class="site-footer"><ul><li><a href=/t>Terms</a></li><li><a href=/p>Privacy</a></li></ul></footer></body></html>""",
        "Five huts worth the climb Some huts have soup, some have a view, and a few have both. The first lies above the tree line, four hours from the road. The last one has no door, which nobody minds in July.",
    ),
    # No container at all: headings and paragraphs straight in the body.
    (
        """<html><head><title>Letter</title></head><body><h1>Letter from the coast</h1><p>Dear all, the storm has passed, and the roof is where it was.</p><p>The boat, however, is in the garden, which is new.</p><p>Write soon, and send nails.</p></body></html>""",
        "Letter from the coast Dear all, the storm has passed, and the roof is where it was. The boat, however, is in the garden, which is new. Write soon, and send nails.",
    ),
    # A newsletter form and sharing buttons below the text.
    (
        """<html><body><div id="page"><ul class="breadcrumb"><li><a href=/>Top</a></li><li><a href=/g>Garden</a></li></ul><div class="article-body"><h2>When to cut roses</h2><p>Wait until the forsythia is in flower, gardeners say, and mostly they are right.</p><p>Cut above a bud that looks outward, and be bold.</p></div>
<div class="share"><a href=#>Send</a> <a href=#>Print</a></div><form class="newsletter"><label>Our letter, every week</label><input type=email><button>Subscribe</button></form></div></body></html>""",
        "When to cut roses Wait until the forsythia is in flower, gardeners say, and mostly they are right. Cut above a bud that looks outward, and be bold.",
    ),
    # End tags left out, upper case, entities.
    (
        """<HTML><BODY><DIV CLASS=menu><A HREF=/>Index</A> <A HREF=/n>Next</A></DIV><DIV ID=content><H1>Caf&eacute; notes</H1><P>The caf&eacute; opens at 7 &amp; closes late, except on Mondays.<P>Its cake is known far &amp; wide.<UL><LI>Plum, in autumn.<LI>Apple, always.</UL></DIV><DIV CLASS=footer>&copy; the owner</DIV></BODY></HTML>""",
        "Café notes The café opens at 7 & closes late, except on Mondays. Its cake is known far & wide. Plum, in autumn. Apple, always.",
    ),
    # An alert above the story and trending stories beside it.
    (
        """<html><body><div role="alert"><p>Trains are delayed in the north, please check before you leave.</p></div><nav><ul><li><a href=/>News</a></li><li><a href=/l>Local</a></li></ul></nav><div class="layout"><div class="main-column"><h1>School garden wins prize</h1><p>Thirty children, two teachers and a borrowed spade turned a yard into a garden.</p><p>The jury liked the pumpkins best, as did the snails.</p></div>
<div class="sidebar widget"><h3>Trending</h3><ol><li><a href=/1>Market moves to the square</a></li><li><a href=/2>Pool closed for repair</a></li></ol></div></div></body></html>""",
        "School garden wins prize Thirty children, two teachers and a borrowed spade turned a yard into a garden. The jury liked the pumpkins best, as did the snails.",
    ),
]
